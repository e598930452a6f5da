
from __future__ import annotations

import html
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Literal entities decoded in this order.
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#8217;", "'"), ("&#8220;", '"'), ("&#8221;", '"'), ("&nbsp;", " "), ("&#8211;", "-"))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: Column | str) -> Column:
    """The value, or null where it is the empty string."""
    return F.nullif(col(c), F.lit(""))


def present(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit("")) != ""


def normalize_title(c: Column | str) -> Column:
    """[S1] Lower case, letters, digits, underscores and single spaces only (of any script)."""
    kept = F.regexp_replace(F.lower(col(c)), r"(?U)[^\p{L}\p{N}_\s]", "")
    return F.trim(F.regexp_replace(kept, r"(?U)\s+", " "))


def normalize_org_name(c: Column | str) -> Column:
    """[S2] ASCII letters, digits and single spaces in lower case, without a leading "the"."""
    kept = F.trim(F.regexp_replace(F.lower(col(c)), "[^a-z0-9 ]", ""))
    return F.trim(F.regexp_replace(F.regexp_replace(kept, "^the ", ""), " +", " "))


def slugify(c: Column | str, mark: str = "_") -> Column:
    """[S3, S5] Runs of other characters than a-z and 0-9 become one mark; none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", mark), f"^{mark}+|{mark}+$", "")


def candidate_slug(c: Column | str) -> Column:
    """[S5]"""
    return F.coalesce(filled(slugify(c, "-")), F.lit("candidate"))


def opportunity_slug(org: Column | str, title: Column | str, start: Column | str, last_seen: Column | str) -> Column:
    """[S4] Organisation (40 characters), title (60) and day, else the last day seen, else "undated"."""
    day = F.coalesce(F.date_format(col(start), "yyyyMMdd"), F.date_format(col(last_seen), "yyyyMMdd"), F.lit("undated"))
    return F.concat_ws("_", F.substring(slugify(org), 1, 40), F.substring(slugify(title), 1, 60), day)


def strip_html(c: Column | str) -> Column:
    """[S6] Tags become spaces, white space runs one space, then the literal entities are decoded one after the other."""
    out = F.trim(F.regexp_replace(F.regexp_replace(col(c), "<[^>]+>", " "), r"(?U)\s+", " "))
    for entity, text in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(text))
    return out


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """[S7] All HTML entities. Rows without an ampersand pass through."""
    return texts.map(lambda t: html.unescape(t) if t and "&" in t else t)


def blob(title: Column | str, description: Column | str, categories: Column | str, tags: Column | str) -> Column:
    """[S8] What keyword rules are matched against; empty parts keep their spaces."""
    return F.concat_ws(" ", col(title), col(description), F.array_join(col(categories), " "), F.array_join(col(tags), " "))


def join_parts(*parts: Column | str) -> Column:
    """[S9] Non-blank parts, trimmed, with ", " between."""
    return F.concat_ws(", ", *[F.nullif(F.trim(col(p)), F.lit("")) for p in parts])


def availability(kind: Column | str, repeats: Column | str, last_seen: Column | str, end: Column | str) -> Column:
    """[S10]"""
    deadline = F.when(col(end).isNotNull(), F.concat(F.lit("Apply by "), F.date_format(col(end), "yyyy-MM-dd"))).otherwise("Rolling — apply anytime")
    series = F.concat(F.lit("Repeats "), col(repeats).cast("string"), F.lit(" times through "), F.date_format(col(last_seen), "yyyy-MM-dd"))
    return F.when(col(kind) == "internship", deadline).when((col(repeats) > 1) & col(last_seen).isNotNull(), series).otherwise("")


def truncate(c: Column | str, most: int = 150) -> Column:
    """[S11] At most so many characters, cut at a word's end, with an ellipsis if cut."""
    cut = F.concat(F.regexp_replace(F.substring(col(c), 1, most), r"(?U)\s+\S*\z", ""), F.lit("…"))
    return F.when(F.length(col(c)) > most, cut).otherwise(F.coalesce(col(c), F.lit("")))


def parse_city(c: Column | str) -> Column:
    """[S12]"""
    return F.coalesce(F.trim(F.split(col(c), ",")[0]), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """[S13] Decoded, without tags, single-spaced, without a navigation word in front."""
    plain = F.regexp_replace(unescape(col(c)), "<[^>]+>", " ")
    return F.coalesce(F.regexp_replace(F.trim(F.regexp_replace(plain, r"(?U)\s+", " ")), r"^(Skip to content|Menu|Close)\s*", ""), F.lit(""))


def clean_title(c: Column | str) -> Column:
    """[S13] Without the site's name after a bar or dash."""
    first = F.trim(F.split(clean_text(c), r"\s*[|–—]\s*(?=[A-Z])")[0])
    return F.trim(F.regexp_replace(first, "[ –—-]+$", ""))


def truncate_description(c: Column | str, most: int = 500) -> Column:
    """[S13] Cut after the last sentence that ends in the second half, else at a word's end with three dots."""
    text = clean_text(c)
    cut = F.substring(text, 1, most)
    # Where the last ". " begins, counted from 0; -1 without one.
    at = F.length(cut) - F.instr(F.reverse(cut), " .") - 1
    at = F.when(F.instr(F.reverse(cut), " .") > 0, at).otherwise(-1)
    words = F.concat(F.regexp_replace(cut, " [^ ]*$", ""), F.lit("..."))
    return F.when(F.length(text) <= most, text).when(at > most // 2, F.substr(cut, F.lit(1), at + 1)).otherwise(words)


def clean_url(c: Column | str) -> Column:
    """[S14] Trimmed, lower case, without slashes at the end and a day after the last slash."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.trim(col(c)), "/+$", "")), r"/\d{4}-\d{2}-\d{2}$", "")


def domain_of(c: Column | str) -> Column:
    """[S15] Host name in lower case, else "unknown"."""
    return F.coalesce(filled(F.lower(F.try_parse_url(col(c), F.lit("HOST")))), F.lit("unknown"))


@F.pandas_udf(StringType())
def url_join(base: pd.Series, link: pd.Series) -> pd.Series:
    """[S18] A link resolved on its page's address; null for what is no address at all."""

    def one(b: str | None, x: str | None) -> str | None:
        try:
            return urljoin(b or "", (x or "").strip())
        except ValueError:
            return None

    return pd.Series([one(b, x) for b, x in zip(base, link)])


def url_encode(c: Column | str) -> Column:
    """[S19] Percent encoding with %20 for a space."""
    return F.replace(F.url_encode(col(c)), F.lit("+"), F.lit("%20"))


def image_path(image: Column | str, logo: Column | str, default: str) -> Column:
    """[S20]"""
    return F.coalesce(filled(image), filled(logo), F.lit(default))
