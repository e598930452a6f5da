"""Mixing, substring removal, Jaccard join, token files and the pipeline against plain loops, and on odd inputs."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fairlead.llm import jaccard, mixing, queries, substrings, tokens
from fairlead.llm.common import stored
from fairlead.llm.graph import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string"
ODD = [(0, None, "a"), (1, "", None), (2, " \n ", "b"), (3, "one two three", "b"), (3, "one two three", "b"), (None, "no id here", None), (4, "x " * 30_000, "c"), (5, "One two  three", "a")]


def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumn("size", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("hash", F.lit(1)).withColumn("n", F.lit(1))


def none(spark):
    return spark.createDataFrame([], DOCS)


def near_copies(seed, n, vocabulary, length=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    texts = [rng.choices(words, k=rng.randint(1, length)) for _ in range(n)]
    passage = rng.choices(words, k=60)
    for i in range(n // 2):
        t = list(texts[rng.randrange(n)])
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        if rng.random() < 0.3:
            t[len(t) // 2 : 0] = passage
        if rng.random() < 0.2:
            t += t[:40]
        texts.append(t)
    rng.shuffle(texts)
    return [(i, " ".join(t), f"s{i % 3}") for i, t in enumerate(texts)] + [(10_000 + i, "same line of words here " * 12, "s") for i in range(20)]


# --- op1


def targets_by_loop(sizes, weights=(1, 2, 3), cap=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in capped)
        share = {s: rest * w[s] / sum(w[x] for x in names if x not in capped) for s in names if s not in capped}
        over = {s for s, t in share.items() if t > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def test_op1_targets_and_sample(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["é", "a", "Z", None, "tiny" if i < 9 else "a", "🙂"])) for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    sizes, taken = {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and r["taken"] <= 3 * r["size"]
    want = targets_by_loop(sizes)
    assert {r["source"]: r["target"] for r in got} == pytest.approx(want) and all(r["source_size"] == sizes[r["source"]] for r in got)
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)


def sample_by_loop(rows, seed=20240229, tolerance=0.001):
    """Documents sorted by random odds over inclusion odds, each taken if it still fits; passes end as the docstring says."""
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets, out = targets_by_loop(sizes), {}
    for s, target in targets.items():
        ratio = target / sizes[s] if sizes[s] else 0.0
        whole = int(ratio + 1e-9)
        p, left = max(ratio - whole, 0.0), round(target - whole * sizes[s])
        few, order = max(1.0, target * tolerance), []
        for i, t, x in rows:
            if x == s:
                out[i] = whole
                u = (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                order.append((u / (1 - u) / (p / (1 - p)) if p else 0.0, i, len((t or "").split())))
        order = sorted(o for o in order if o[2] and p)
        first = left > 0
        while order and (first or left >= few):
            first, order = False, [o for o in order if o[2] <= left]
            while order and order[0][2] <= left:
                _, i, n = order.pop(0)
                out[i] += 1
                left -= n
    return out


def test_op1_against_a_loop(spark):
    rng = random.Random(12)
    rows = [(i, "w " * rng.choice([0, 1, 3, 40, rng.randint(1, 900)]), rng.choice(["a", "b", "b", "b", "c", None, "tiny" if i < 30 else "a"])) for i in range(1500)]
    got = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == sample_by_loop(rows)


def test_op1_rows_with_one_id_and_source(spark):
    rows = [(1, "w " * n, "a") for n in (1, 5, 50, 500)] + [(i, "w " * 20, "b") for i in range(50)] + [(None, "w " * 7, "b"), (None, "w " * 7, "b")]
    docs = spark.createDataFrame(rows, DOCS)
    copies = sorted((str(r["doc_id"]), r["size"], r["copies"]) for r in mixing.mix(docs).collect())
    out = {}
    for r in mixing.mixed_documents(docs).collect():
        k = (str(r["doc_id"]), len(r["text"].split()))
        out[k] = out.get(k, 0) + 1
    want = {}
    for i, n, c in copies:
        want[i, n] = want.get((i, n), 0) + c
    assert out == {k: c for k, c in want.items() if c} and all(c <= 3 for *_, c in copies)


def test_op1_on_odd_documents(spark):
    got = mixing.mix(odd(spark))
    assert got.count() == len(ODD) and got.filter("taken > 3 * size or copies < 0").count() == 0
    assert mixing.mix(none(spark)).count() == 0
    out = mixing.mixed_documents(odd(spark))
    assert out.columns == odd(spark).columns


# --- op6


def removed_by_loop(rows, window=20):
    seen, out = set(), {}
    for i, t, *_ in sorted(((i, t) for i, t, *_ in rows if i is not None), key=lambda r: r[0]):
        w = (t or "").split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            if k in seen:
                gone[s : s + window] = [True] * window
            seen.add(k)
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot,shard", [(5_000, 3_000), (3, 5)])
def test_op6_against_a_loop(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(substrings, "HOT_PIECES", hot)
    monkeypatch.setattr(substrings, "SHARD_PIECES", shard)
    rows = near_copies(4, 150, 40) + [(20_000, "ab " * 400, "s"), (20_001, "ab cd " * 100, "s"), (20_002, "ab " * 19, "s")]
    got = substrings.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    want = removed_by_loop(rows)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in got} == want


def test_op6_rows_with_one_id_and_different_texts(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))
    a, b = text(40), text(40)
    c = " ".join(b.split()[:25]) + " " + text(10)
    rows = [(1, a, "s"), (5, a, "s"), (5, b, "s"), (5, b, "s"), (9, c, "s"), (None, a, "s"), (5, None, "s"), (5, "", "s")]
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(3)).collect()))
    assert got == sorted([(1, 40, 0), (5, 40, 40), (5, 40, 0), (5, 40, 0), (9, 35, 25), (0, 40, 0), (5, 0, 0), (5, 0, 0)])


def test_pieces_of_a_batch_are_those_of_each_text():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 4, n).astype(np.uint64) for n in (0, 5, 20, 300, 19, 0, 21, 1000, 0)]
    ends = np.append(0, np.cumsum([len(t) for t in texts]))
    got = [np.concatenate(x).tolist() for x in zip(*(substrings.pieces_of_texts(np.concatenate(texts), ends, 20, 5),))]
    for i, t in enumerate(texts):
        own = substrings.pieces(t, np.array([0, len(t)]), 20, 5)
        at = [k for k, x in enumerate(got[0]) if x == i]
        assert [[g[k] for k in at] for g in got[1:]] == [x.tolist() for x in own[1:]]
        assert sum(own[4]) == max(0, len(t) - 19)


def test_automaton_statistics():
    rng = random.Random(6)
    for _ in range(200):
        held = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(4)]
        a = substrings.Automaton()
        for s in held:
            a.add(s)
        t = [rng.randrange(4) for _ in range(15)]
        parts = {tuple(s[i:j]) for s in held for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        assert a.matches(t) == [max([0] + [n for n in range(1, e + 2) if tuple(t[e + 1 - n : e + 1]) in parts]) for e in range(len(t))]


def test_op6_on_odd_documents(spark):
    got = substrings.remove_repeats(odd(spark)).collect()
    assert len(got) == len(ODD) and {r["doc_id"]: r["n_removed"] for r in got}[4] == 30_000 - 0 - sum(1 for _ in range(20)) + 19
    assert substrings.remove_repeats(none(spark)).count() == 0


# --- op7


def components_by_loop(rows, n, num, den):
    def shingles(t):
        w = (t or "").split()
        w = [x.lower() for x in w]
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t, *_ in rows}
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                r, s = find(a), find(b)
                parent[max(r, s)] = min(r, s)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n,num,den,block,docs", [(3, 90, 100, 1_000_000, 2_000), (5, 80, 100, 1_000_000, 2_000), (3, 90, 100, 300, 4)])
def test_op7_against_a_loop(spark, monkeypatch, n, num, den, block, docs):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", docs)
    rows = near_copies(8, 160, 2000) + [(30_000 + i, "a b c d e f g h i j k l m n o p q r s t u v w x y " + "z" * (i % 4), "s") for i in range(12)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, DOCS).repartition(5), n, num, den).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components_by_loop(rows, n, num, den)


def test_divide_skip_finds_all_components():
    rng = random.Random(3)
    for t in range(40):
        sets = []
        for _ in range(30):
            base = set(rng.sample(range(300), rng.randint(1, 60))) if not sets or rng.random() < 0.4 else set(map(int, rng.choice(sets)))
            base = set(rng.sample(sorted(base), max(1, len(base) - rng.randrange(3)))) | set(rng.sample(range(300), rng.randrange(3)))
            sets.append(np.array(sorted(base), np.uint64))
        parent = list(range(30))
        mine = list(range(30))

        def find(p, i):
            while p[i] != i:
                i = p[i]
            return i

        for a, b in jaccard.link_block(sets, 80, 100):
            mine[find(mine, a)] = find(mine, b)
            s, u = set(sets[a].tolist()), set(sets[b].tolist())
            assert 100 * len(s & u) >= 80 * len(s | u)
        for a in range(30):
            for b in range(a):
                s, u = set(sets[a].tolist()), set(sets[b].tolist())
                if 100 * len(s & u) >= 80 * len(s | u):
                    parent[find(parent, a)] = find(parent, b)
        same = lambda p: {(a, b) for a in range(30) for b in range(a) if find(p, a) == find(p, b)}
        assert same(parent) == same(mine)


def test_linked_sets_share_a_shingle_of_their_prefixes(monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_COUNTED", 6)
    rng = random.Random(11)
    for num in (90, 80):
        prefixes, sets = jaccard.Prefixes(num, 100), []
        for _ in range(300):
            x = {rng.getrandbits(64) for _ in range(rng.randint(1, 150))} if not sets or rng.random() < 0.3 else set(rng.choice(sets))
            sets.append(set(rng.sample(sorted(x), len(x) - rng.randint(0, len(x) // 10))) | {rng.getrandbits(64) for _ in range(rng.randint(0, len(x) // 10))})
        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        rows = pd.DataFrame([(x, i) for i, a in enumerate(arrays) for x in prefixes.first(a).view(np.int64).tolist()] * 2, columns=["sign", "h1"]).sort_values(["sign", "h1"], ignore_index=True)
        got = pd.concat(jaccard.counts(rows[k : k + 7] for k in range(0, len(rows), 7))).drop_duplicates()
        want = rows.drop_duplicates().groupby("sign").h1.count()
        assert (got.set_index("sign").sets == want[got.sign].clip(upper=6)).all() and len(got) == want[want > 1].sum()
        taken = {}
        for i, g in got.groupby("h1"):
            sign = g.sign.to_numpy()
            taken[i] = set(sign[prefixes.shared(len(arrays[i]), prefixes.counted(arrays[i]), sign.view(np.uint64), g.sets.to_numpy())].tolist())
        for a in range(300):
            for b in range(a):
                if sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    assert taken.get(a, set()) & taken.get(b, set())


def test_sketches_part_no_linked_sets():
    rng = random.Random(12)
    for num in (90, 80):
        sets = []
        for _ in range(60):
            x = {rng.getrandbits(63) for _ in range(rng.randint(1, 300))} if not sets or rng.random() < 0.4 else set(rng.choice(sets))
            y = set(rng.sample(sorted(x), len(x) - rng.randint(0, len(x) // 8))) | {rng.getrandbits(63) for _ in range(rng.randint(0, len(x) // 8))}
            sets.append(y)
        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        label = jaccard.feasible_groups(np.array([len(s) for s in sets]), [jaccard.sketch(a) for a in arrays], num, 100)
        assert len(set(label.tolist())) > 5
        for a in range(60):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    assert label[a] == label[b]


def test_op7_on_odd_documents(spark):
    got = jaccard.jaccard_components(odd(spark)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == sorted([(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (3, 1, 3), (None, 1, None), (4, 1, 4), (5, 1, 3)], key=str)
    assert jaccard.jaccard_components(none(spark)).count() == 0
    assert jaccard.keep_one(odd(spark)).columns == odd(spark).columns


def test_op7_null_ids_ahead_of_near_copies(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text, "s"), (7, text, "s"), (None, text + " more", "s"), (9, text + " more", "s"), (8, "other words here", "s")]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    got = jaccard.jaccard_components(docs).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=str) == sorted([(None, None), (None, None), (7, 7), (9, 7), (8, 8)], key=str)
    assert sorted((r["doc_id"] for r in jaccard.keep_one(docs).collect()), key=str) == sorted([None, None, 7, 8], key=str)


def test_keep_one_of_rows_with_one_id(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a, "s"), (1, a, "t"), (1, b, "s"), (2, b + " more", "s"), (3, "", "s"), (3, "", "s"), (None, a, "s"), (None, a, "s"), (4, None, "s")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("id", F.lit(0)).withColumn("row", F.lit(0)).withColumn("hash", F.lit(0))
    got = jaccard.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], (r["text"] or "")[:1]) for r in got.collect()), key=str) == sorted([(1, "a"), (1, "b"), (3, ""), (3, ""), (None, "a"), (None, "a"), (4, "")], key=str)


def test_what_is_stored_in_passing_goes(spark):
    from fairlead.llm import common

    with common.passing(spark):
        df = common.stored(spark.range(3), "test")
        path = df.inputFiles()[0].removeprefix("file://")
        assert df.count() == 3
    assert not __import__("os").path.exists(path)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 60), (60, 80), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((60, 80, 100), 60)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- op8


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 32])
def test_packing(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    raw = tokens.pack(ids, bits)
    assert len(raw) == -(-1001 * bits // 8) and (tokens.unpack(raw, bits, 1001) == ids).all()
    assert all((tokens.unpack(raw, bits, n, s) == ids[s : s + n]).all() for s, n in ((0, 1), (5, 10), (1000, 1), (333, 600), (7, 0)))
    assert tokens.width(49_408) == 16 and tokens.width(2) == 1 and tokens.width(1) == 1


def test_words_give_what_whole_texts_give():
    e = tokens.encoder(queries.tokenizer())
    assert e.apart
    rng = random.Random(1)
    parts = [*" \n\t.,'\"aBéé́Σßİ1②　²½ ſK—’-", "<|endoftext|>", "<|ENDOFTEXT|>", " 's", "'S ", "I'M", "'ll", "<|startoftext|>", "...", "3's", "hello", "Ωmega", "क़", "\x00", "\x1f"]
    for _ in range(3000):
        t = "".join(rng.choices(parts, k=20))
        assert e.encode(t).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_op8_round_trip(spark, tmp_path):
    t = tokens.encoder(queries.tokenizer()).tokenizer
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in queries.op8_token_files(spark, SF).collect()}
    start = 0
    for i, x in rows:
        ids = [*t.encode(x, add_special_tokens=False).ids, 1]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    path = str(tmp_path / "files")
    tokens.write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), path, queries.tokenizer(), 49_408, block_ids=500)
    assert tokens.read_document(spark, path, rows[7][0]).tolist() == [*t.encode(rows[7][1], add_special_tokens=False).ids, 1]
    assert tokens.read_document(spark, path, -5) is None


def test_op8_on_odd_documents(spark):
    got = tokens.token_files(odd(spark), queries.tokenizer(), 49_408).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [-(2**63), 0, 1, 2, 3, 3, 4, 5] and [r["n_tokens"] for r in got][1:4] == [1, 1, 1]
    assert tokens.token_files(none(spark), queries.tokenizer(), 49_408).count() == 0


# --- pipeline


def test_pipeline_keeps_columns_and_its_decisions_take_effect(spark):
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), None
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "test")
        assert out.columns == columns, name
        if name != "mixing sources":
            assert out.join(docs, "doc_id", "left_anti").count() == 0 and 0 < out.count() <= docs.count()
        before, docs = docs, out
    seen = {r["doc_id"]: r["n"] for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert max(seen.values()) <= 3 and set(seen) <= {r["doc_id"] for r in before.select("doc_id").collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == docs.count() and sum(r["n_tokens"] for r in last) == max(r["start"] + r["n_tokens"] for r in last)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    none(spark).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_pipeline_survives_odd_documents(spark, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), "test")
        assert docs.columns == odd(spark).columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
