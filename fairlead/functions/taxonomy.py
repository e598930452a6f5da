"""Classification by keyword rules. Rules are data; each rule set becomes one column expression without a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# The vocabulary and patterns that results must agree with.
AREAS = (
    (r"\b(marine|ocean|aquarium|shark|whale|dolphin|turtle|fish|tide\s*pool|bird|wildlife|animal|insect|bug|reptile|zoo)\b", "Biology / LifeSciences"),
    (r"\b(ecolog|environment|conservation|climate|recycl|compost|watershed|garden|farm|nature|habitat|creek|lagoon|river)\b", "Earth Science/Ecology"),
    (r"\b(coding|code|program(?:ming)?|computer|robot|scratch|python|minecraft|cyber|video game)\b", "Coding/Computer Science/Cyber Security"),
    (r"\b(engineer|maker|build|lego|3d print|circuit|invention|design challenge)\b", "Engineering"),
    (r"\b(astronomy|planetarium|telescope|space|rocket|star|planet)\b", "Physical Science"),
    (r"\b(math|algebra|geometry)\b", "Mathematics"),
    (r"\b(chemistry|chemical)\b", "Chemistry"),
    (r"\b(physics)\b", "Physics"),
)
AGES = (
    (r"\b(famil(?:y|ies)|all ages)\b", "Family"),
    (r"\b(toddler|preschool|pre-k|ages? [0-5]\b)\b", "Pre-K"),
    (r"\b(teen|high school|grades? 9)\b", "Grades 9-12"),
    (r"\b(middle school|tween|grades? 6)\b", "Grades 6-8"),
    (r"\b(adult)\b", "Adult"),
)
TYPES = (
    (r"\b(clean[\s-]?up|litter|street sweep|beach sweep|restoration|stewardship|volunteer day|service learning|trail work)\b", "Volunteering"),
    (r"\b(virtual|webinar|online|livestream|live stream)\b", "Online"),
    (r"\b(professional development|conference|symposium|colloquium|educator workshop|teacher (?:training|workshop))\b", "Professional Development / Conferences"),
    (r"\b(career fair|job fair|college fair|career day|internship fair)\b", "Career Connections"),
    (r"\b(field trip|school program|in-school|school group|for schools|school assembly)\b", "School Programs"),
)
DEFAULT_AREA, DEFAULT_TYPE, INTERNSHIP_TYPE = "General Science", "Out-of-school Programs", "Work-based Learning"
COST_CAPS = ((25, "Less than $25"), (50, "Less than $50"), (100, "Less than $100"), (200, "Less than $200"))
INTERNSHIP = r"\bintern(?:s|ship|ships)?\b|\bco[- ]?op\b|\bapprentice(?:ship)?\b|\bearly[- ]career\b"
STEM_JOB = (
    r"\bengineer(?:ing|s)?\b|\bsoftware\b|\bdata\b|\b(biology|biomedical|bioinformatics|genomics|biotech)\b|\b(chemistry|chemical)\b|\bphysics\b"
    r"|\b(hardware|firmware)\b|\b(robotics|robot|machine learning|\bml\b|\bai\b|artificial intelligence)\b|\b(mechanical|electrical|aerospace)\b"
    r"|\b(manufacturing|laboratory|\blab\b|r&d|research)\b|\b(semiconductor|wireless)\b|\bscientist\b"
)
GRADUATE = r"\b(ph\.?d|doctoral|graduate|master'?s|msc|postdoc(?:toral)?)\b"
LOCAL = ("San Diego",)
POSTING_AGES = ("Grades 9-12", "Undergraduate")
YOUTH_AUDIENCE = ("child", "children", "kid", "kids", "family", "families", "teen", "tween", "baby", "babies", "toddler", "preschool", "pre-k", "prek", "youth", "school age", "school-age", "all ages", "grade", "birth")
STEM_STRONG = (
    r"\b(stem|science|coding|robotics?|programming|engineer|computer science|biology|chemistry|physics|astronomy|ecology|marine biology"
    r"|maker\s*space|3d print|arduino|raspberry pi|scratch|python|drone|circuit|electronics|specimen|microscope|fossil|dinosaur"
    r"|telescope|planetarium|tide\s*pool|dissect|lab\b|experiment|biotech|genome|dna|species|habitat|ecosystem|watershed"
    r"|solar|renewable|climate change|carbon|recycle|compost|invention|innovate|prototype|design challenge)\b"
)
STEM_MODERATE = (
    r"\b(nature|wildlife|animal|bird|fish|shark|turtle|whale|dolphin|garden|plant|tree|seed|harvest|farm|soil|organic"
    r"|ocean|reef|lagoon|creek|river|watershed|water quality|museum|aquarium|zoo|exhibit|discovery|math|geometry|algebra|calculus|statistics"
    r"|space|rocket|satellite|planet|star|moon|engineer|build|construct|design|create|code|explore|investigate|observe|collect|identify)\b"
)
YOUTH = (
    r"\b(youth|kids|children|child|student|family|families|teen|teenager|girl|boy|scout|junior|young|elementary|middle school|high school"
    r"|k-\d|grade\s*\d|ages?\s*\d|preschool|kindergarten|toddler|after.?school|afterschool|summer camp|day camp|spring break"
    r"|field trip|school group|homeschool|parent|storytime|learning|educational|hands.?on|interactive"
    r"|camp\b|class\b|lesson|workshop|program\b|club\b|intern\b|mentor|scholarship|fellows)\b"
)
NOISE = (
    r"\b(earnings|investor|quarterly|shareholder|annual report|10-k|sec filing|board meeting|staff meeting|hiring|job opening|career fair"
    r"|wine|beer|cocktail|happy hour|gala|fundrais|auction|luncheon|grant program|block grant|procurement|construction bid|rfp|rfq"
    r"|mixer|networking event|conference call|press release|media advisory|yoga|meditation|pilates|zumba|fitness"
    r"|wedding|birthday party|rental|private event|census|voting|election|council meeting|city council|zoning"
    r"|worship|sermon|mass\b|prayer|bible|church|french|spanish|german|arabic|chinese|danish|dutch|filipino"
    r"|real estate|mortgage|insurance|tax prep|financial planning|blood drive|vaccination|flu shot|dog walk|cat|pet adoption"
    r"|osha|safety certificate|compliance training|succulent|floral|flower arranging|wreath|quilt|crochet|knit|craft"
    r"|comedy|improv|karaoke|trivia night|bingo|movie night|film festival|book club|poetry|writing group|author reading"
    r"|community development|block grant|zoning|permit|city plan)\b"
)
ORG_BONUS = (
    (("Afterschool/Out-of-School Time", "Curriculum Provider"), 0.3),
    (("Museums, Science Centers & Zoos", "District/School"), 0.2),
    (("Colleges, Universities, and Certificate/Credential Programs",), 0.1),
)
URL_BONUS = ("/camp", "/class", "/program", "/workshop", "/youth", "/kids", "/student", "/education")
EVENT_PATH = r"/(events?|tribe_events|public-events?|science-events?|programs?|courses?|camps?|classes|workshops?|training|calendar)(/|$)"
SITEMAPS = (
    (r"tribe_events|tribe_event_series|tribe_events_cat|tribe_venue|tribe_organizer|tec_recurring|ajde_events|stec_event|event|events", "event"),
    (r"program|course|workshop|camp|class|training", "program"),
    (r"product|store", "product"),
    (r"post|blog|news|article|press", "post"),
    (r"category|tag|taxonomy|cat", "category"),
    (r"author|user", "author"),
    (r"page", "page"),
    (r"sitemap_index|sitemap-index", "index"),
)


def is_ascii(c: Column | str) -> Column:
    return F.length(col(c)) == F.octet_length(col(c))


def matches(c: Column | str, pattern: str) -> Column:
    """Case is folded for letters of any script; word boundaries are Unicode ones. ASCII texts, where that makes no difference, are
    spared the cost."""
    found = F.when(is_ascii(c), F.rlike(col(c), F.lit(f"(?i){pattern}"))).otherwise(F.rlike(col(c), F.lit(f"(?iuU){pattern}")))
    return F.coalesce(found, F.lit(False))


def tag_by_keywords(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """[T1] Labels of all rules that match, in rule order, each once."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(matches(c, p), F.lit(label)) for p, label in rules])))


def areas_of_interest(c: Column | str) -> Column:
    """[T2]"""
    found = tag_by_keywords(c, AREAS)
    return F.when(F.size(found) == 0, F.array(F.lit(DEFAULT_AREA))).otherwise(found)


def age_grade_level(c: Column | str) -> Column:
    """[T3]"""
    return tag_by_keywords(c, AGES)


def opportunity_type(title: Column | str) -> Column:
    """[T4] The first rule that the title alone matches."""
    return F.coalesce(*[F.when(matches(title, p), F.lit(label)) for p, label in TYPES], F.lit(DEFAULT_TYPE))


def cost_range(c: Column | str) -> Column:
    """[T5] From the least dollar amount; commas are not understood; short texts without an amount are kept."""
    text = F.coalesce(col(c), F.lit(""))
    low = F.array_min(F.transform(F.regexp_extract_all(text, F.lit(r"\$\s*(\d+(?:\.\d{1,2})?)"), F.lit(1)), lambda x: x.cast("double")))
    plain = F.lower(F.trim(text))
    out = F.when(text == "", "").when(F.contains(plain, F.lit("free")) | plain.isin("$0", "0", "$0.00") | (low == 0), "Free")
    for cap, label in COST_CAPS:
        out = out.when(low < cap, label)
    return out.when(low.isNotNull(), "Greater than $200").when(F.length(text) <= 40, text).otherwise("")


def time_of_day(start: Column | str, all_day: Column | str) -> Column:
    """[T6]"""
    hour = F.hour(col(start))
    return (
        F.when(col(all_day), F.array(F.lit("All Day")))
        .when(hour < 12, F.array(F.lit("Morning")))
        .when(hour < 17, F.array(F.lit("Afternoon")))
        .when(hour.isNotNull(), F.array(F.lit("Evening")))
        .otherwise(F.array().cast("array<string>"))
    )


def is_internship(title: Column | str, commitment: Column | str) -> Column:
    """[P1]"""
    return matches(title, INTERNSHIP) | matches(commitment, INTERNSHIP)


def is_stem_job(title: Column | str, department: Column | str) -> Column:
    """[P2]"""
    return matches(F.concat_ws(" ", col(title), col(department)), STEM_JOB)


def is_local(location: Column | str, words: Column | None = None) -> Column:
    """[P3] Holds one of the words in any case; without a list of its own, the default ones."""
    words = F.array(*map(F.lit, LOCAL)) if words is None else F.coalesce(words, F.array(*map(F.lit, LOCAL)))
    return F.coalesce(F.exists(words, lambda w: F.contains(F.lower(col(location)), F.lower(w))), F.lit(False))


def classify_posting(title: Column | str, commitment: Column | str, department: Column | str, location: Column | str, words: Column | None = None) -> Column:
    """[P4] struct<age_grade_level, time_of_day> for a local STEM internship, else null."""
    ages = F.array(*map(F.lit, POSTING_AGES))
    ages = F.when(matches(title, GRADUATE), F.concat(ages, F.array(F.lit("Graduate")))).otherwise(ages)
    return F.when(is_internship(title, commitment) & is_stem_job(title, department) & is_local(location, words), F.struct(ages.alias("age_grade_level"), F.array(F.lit("All Day")).alias("time_of_day")))


def is_youth_audience(names: Column | str) -> Column:
    """Some name holds some keyword; nothing known counts as a yes."""
    words = F.array(*map(F.lit, YOUTH_AUDIENCE))
    return (F.coalesce(F.size(col(names)), F.lit(0)) <= 0) | F.exists(col(names), lambda n: F.exists(words, lambda w: F.contains(F.lower(n), w)))


def relevance(title: Column | str, description: Column | str, org: Column | str, org_type: Column | str, audience: Column | str, url: Column | str, included: Sequence[str] = (), excluded: Sequence[str] = ()) -> Column:
    """[T7] struct<relevant, score, reason>; organisations in `included` score 1, those in `excluded` 0. Relevance is decided
    before rounding; the score is not rounded here."""
    text = F.concat_ws(" ", *[F.coalesce(col(c), F.lit("")) for c in (title, description, audience)])
    count = lambda p: F.when(is_ascii(text), F.regexp_count(text, F.lit(f"(?i){p}"))).otherwise(F.regexp_count(text, F.lit(f"(?iuU){p}")))
    strong, moderate, youth, noise = map(count, (STEM_STRONG, STEM_MODERATE, YOUTH, NOISE))
    score = F.least(strong * 0.3, F.lit(0.6)) + F.least(moderate * 0.1, F.lit(0.3)) + F.least(youth * 0.15, F.lit(0.4)) - noise * 0.3
    bonus = F.lit(0.0)
    for kinds, more in reversed(ORG_BONUS):
        bonus = F.when(col(org_type).isin(*kinds), more).otherwise(bonus)
    path = F.lit(False)
    for k in URL_BONUS:
        path = path | F.coalesce(F.contains(F.lower(col(url)), F.lit(k)), F.lit(False))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score + bonus + F.when(path, 0.15).otherwise(0.0)))
    named = [F.when(n > 0, F.concat(F.lit(f"{k}="), n.cast("string"))) for k, n in (("stem_strong", strong), ("stem_mod", moderate), ("youth", youth), ("noise", noise))]
    reason = F.coalesce(F.nullif(F.concat_ws(",", *named), F.lit("")), F.lit("low_signal"))
    row = lambda r, s, why: F.struct(r.alias("relevant"), s.alias("score"), why.alias("reason"))
    out = row(score >= 0.35, score, reason)
    if excluded:
        out = F.when(col(org).isin(*excluded), row(F.lit(False), F.lit(0.0), F.lit("not_relevant_org"))).otherwise(out)
    if included:
        out = F.when(col(org).isin(*included), row(F.lit(True), F.lit(1.0), F.lit("stem_org"))).otherwise(out)
    return out


def event_kind(url: Column | str, title: Column | str) -> Column:
    """[T8]"""
    text = F.lower(F.concat_ws(" ", col(url), col(title)))
    has = lambda *words: F.lit(False) if not words else F.rlike(text, F.lit("|".join(words)))
    return F.when(has("camp"), "camp").when(has("class", "lesson"), "class").when(has("workshop"), "workshop").when(has("course", "training"), "course").when(has("program"), "program").otherwise("event")


def sitemap_kind(filename: Column | str) -> Column:
    """[T9]"""
    name = F.replace(F.lower(col(filename)), F.lit(".xml"), F.lit(""))
    return F.coalesce(*[F.when(F.rlike(name, F.lit(p)), F.lit(label)) for p, label in SITEMAPS], F.lit("other"))


def tier(event_sitemaps: Column, program_sitemaps: Column, listed: Column, sitemaps: Column, dirs: Column, plugin: Column, platform: Column) -> Column:
    """[T10] struct<tier, strategy> from what is known of a site: numbers of sitemaps by kind, of listed event or program URLs, of
    all sitemaps and of event or program directories, the event plugin ("none") and the platform."""
    row = lambda t, s: F.struct(F.lit(t).alias("tier"), (s if isinstance(s, Column) else F.lit(s)).alias("strategy"))
    return (
        F.when((event_sitemaps > 0) & (plugin != "none"), row("1A", F.concat(F.lit("event_sitemap+"), plugin)))
        .when((event_sitemaps > 0) & (platform == "wix"), row("1C", "wix_event_sitemap"))
        .when(event_sitemaps > 0, row("1A", "event_sitemap+generic"))
        .when(program_sitemaps > 0, row("1B", "program_sitemap"))
        .when(listed > 0, row("2", "filtered_general_sitemap"))
        .when((sitemaps > 0) & (dirs > 0), row("2", "sitemap+dir_scan"))
        .when(dirs > 0, row("3", "dir_scan_only"))
        .when(sitemaps > 0, row("4", "sitemap_keyword_search"))
        .otherwise(row("4", "full_scan"))
    )


def platform(html: Column | str, domain: Column | str) -> Column:
    """[T11] From the first 50,000 characters of a site's first page."""
    low = F.lower(F.substring(col(html), 1, 50_000))
    has = lambda *words: F.rlike(low, F.lit("|".join(w.replace(".", r"\.") for w in words)))
    out = F.when(has("wp-content", "wordpress"), "wordpress").when(has("wixstatic.com", "wix.com"), "wix").when(has("squarespace"), "squarespace").when(has("drupal"), "drupal")
    return F.when(col(html).isNull(), "unknown").otherwise(out.when(F.contains(col(domain), F.lit("sites.google.com")), "google_sites").otherwise("other"))


def plugins(html: Column | str) -> Column:
    """[T11] Event plugins that the first 30,000 characters of a page show."""
    low = F.lower(F.substring(col(html), 1, 30_000))
    rules = (("tribe-events|the-events-calendar|wp-json/tribe", "tribe_events_calendar"), ("stec-|starter-templates-events", "stec"), ("ajde_evcal|eventon", "eventon"), ("events-manager", "events_manager"))
    return F.array_compact(F.array(*[F.when(F.rlike(low, F.lit(p)), F.lit(k)) for p, k in rules]))


def record_confidence(title: Column, date_text: Column, description: Column, registration: Column, api: Column, method: Column) -> Column:
    """[T12]"""
    there = lambda c: F.coalesce(c, F.lit("")) != ""
    parts = ((there(title), 0.2), (there(date_text), 0.3), (there(description), 0.15), (there(registration), 0.15), (there(api), 0.1), (F.contains(method, F.lit("sitemap")), 0.1))
    total = F.lit(0.0)
    for c, x in parts:
        total = total + F.when(c, x).otherwise(0.0)
    return F.least(total, F.lit(1.0))
