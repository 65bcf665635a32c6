"""Each text operator against a brute-force version or an exact round trip, and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.llm import chat, common, decontaminate, graph, language, line_dedup, mix, quality, queries, simhash, tokens, url_filter, warc
from fairlead.llm.common import materialize, skew_join

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 60_000
#: Nulls in every column, empty and blank texts, repeated rows, ties, one long text.
ODD = [
    (None, None, None, None, None),
    (1, "", "en", "s", 0),
    (2, " \n\t ", "en", "s", 4),
    (3, "one", None, "s", 3),
    (3, "one", None, "s", 3),
    (4, "a b c d e f g h i j k l", "en", None, 23),
    (5, "a b c d e f g h i j k l", "en", "t", 23),
    (6, "x y\nz w\nv u\nx y\nz w\nv u", "fr", "t", 23),
    (7, LONG, "fr", "t", len(LONG)),
    (None, "Ünïcödé ☃ text", "de", "t", 14),
]
#: Names that operators use inside or return.
CLASHING = ["n_words", "n_tokens", "fp", "node", "copies", "_in", "at", "_c0", "lang_pred", "host", "kept", "key", "size", "id"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, DOCS)
    return df.withColumns({c: F.lit("own") for c in CLASHING})


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


def docs_of(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(name, same_as_sql):
    same_as_sql(queries.QUERIES[name], queries.ORACLE[name])


# 1. Mixing


def test_targets():
    assert mix.targets([10, 10, 10], [1, 1, 1]) == [10, 10, 10]
    got = mix.targets([100, 1, 100], [5, 2, 1])
    assert got[1] == 3 and math.isclose(sum(got), 201) and math.isclose(got[0] / got[2], 5)
    assert mix.targets([0, 0], [5, 2]) == [0, 0] and mix.targets([], []) == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.floats(0.01, 0.99), st.integers(1, 500)), min_size=1, max_size=60))
def test_duels_keep_the_mass(items):
    p, w = np.array([x for x, _ in items]), np.array([float(y) for _, y in items])
    got, left = mix.duel(p, w, np.random.default_rng(1).random(len(p)))
    assert sum(0 < x < 1 for x in got) <= 1 and (left < 0 or 0 < got[left] < 1)
    assert math.isclose((got * w).sum(), (p * w).sum(), rel_tol=1e-6)


def test_duels_are_fair():
    rng = np.random.default_rng(2)
    p, w = np.array([0.3, 0.7, 0.5]), np.array([10.0, 20.0, 5.0])
    mean = np.mean([mix.duel(p, w, rng.random(3))[0] for _ in range(20_000)], axis=0)
    assert np.allclose(mean, p, atol=0.015)


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(3)
    texts = ["w " * rng.randint(1, 60) for _ in range(3000)]
    sources = [rng.choice(["a", "a", "a", "b", "c", None]) for _ in texts]
    docs = docs_of(spark, texts, sources)
    got = mix.mix_counts(docs, leaf=100, fan=4).collect()
    assert len(got) == len(texts)
    for source in {"a", "b", "c", None}:
        rows = [r for r in got if r["source"] == source]
        assert sum(r["size"] for r in rows) == rows[0]["source_size"] == sum(len(words(t)) for t, s in zip(texts, sources, strict=True) if s == source)
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 60
        assert all(r["taken"] <= 3 * r["size"] for r in rows)
    key = lambda rows: sorted((r["doc_id"], r["taken"]) for r in rows)
    assert key(got) == key(mix.mix_counts(docs.repartition(7), leaf=100, fan=4).collect())
    assert sum(r["copies"] * len(words(r["text"])) for r in mix.mix(docs, leaf=100, fan=4).collect()) == sum(r["taken"] for r in got)


def test_mix_rows_with_one_id(spark):
    """Repeated rows, and different texts with a null or shared id and the same size, keep their own draws."""
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, i]), " ".join(rng.choice("abcdef") for _ in range(rng.randint(5, 7))), "en", rng.choice("stu"), 0) for i in range(400)]
    docs = spark.createDataFrame(rows + rows[:100], DOCS)
    got = mix.mix(docs, leaf=50, fan=4).collect()
    counts = mix.mix_counts(docs, leaf=50, fan=4).collect()
    key = lambda r: (str(r["doc_id"]), r["source"])
    assert sorted((*key(r), len(words(r["text"])), r["copies"]) for r in got) == sorted((*key(r), r["size"], r["copies"]) for r in counts if r["copies"])
    again = mix.mix(docs.repartition(7), leaf=50, fan=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def tree(size, p, leaf_of, fan, seed):
    """Rounds rows as the operator does, group by group and level by level, largest first."""
    size, p, levels = np.array(size, dtype=float), np.array(p), 0
    while fan**levels <= max(leaf_of):
        levels += 1
    for level in range(levels + 1):
        for leaf in set(leaf_of.tolist()):
            mine = np.flatnonzero((leaf_of == leaf) & (p > 0) & (p < 1))
            mine = mine[np.lexsort((mine, -size[mine]))]
            p[mine] = mix.round_rows(size[mine], p[mine], (mine * 7919).astype(np.uint64), level, seed, level == levels)
        leaf_of = leaf_of // fan
    return p


@pytest.mark.parametrize("leaves", [1, 6])
def test_every_document_keeps_its_probability(leaves):
    """One large document among small ones: over many seeds each is taken as often as its probability says, and the source's total stays within one document."""
    size, seeds = [100] + [7] * 19 + [3, 11, 40], 2000
    p = np.full(len(size), 0.3)
    leaf_of = np.arange(len(size)) % leaves
    got = np.array([tree(size, p, leaf_of, 3, seed) for seed in range(seeds)])
    assert set(np.unique(got)) <= {0.0, 1.0}
    assert np.abs(got.mean(axis=0) - p).max() <= 4 * math.sqrt(0.3 * 0.7 / seeds)
    totals = got @ np.array(size, dtype=float)
    assert np.abs(totals - 0.3 * sum(size)).max() <= (20 if leaves == 1 else 100)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=60), st.floats(0.01, 0.99), st.integers(0, 2**32))
def test_settling_keeps_the_mass(sizes, p, seed):
    w = np.array(sorted(sizes, reverse=True), dtype=float)
    ends, one = mix.settle(p, w, np.random.default_rng(seed).random(len(w)), True)
    assert abs((ends * w).sum() - p * w.sum()) <= w[0] and all(x in (0, 1) for i, x in enumerate(ends) if i != one)
    got, left = mix.settle(p, w, np.random.default_rng(seed).random(len(w)), False)
    assert sum(0 < x < 1 for x in got) == (left >= 0) and (left < 0 or 0 < got[left] < 1)
    assert math.isclose((got * w).sum(), p * w.sum(), rel_tol=1e-9, abs_tol=1e-6)


def test_mix_of_a_row_repeated_often(spark):
    """Equal rows are dealt over many leaves and each keeps its own draw."""
    rows = [(None, "a b c", "en", "s", 0)] * 3000 + [(i, "d e f g", "en", "t", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mix.mix_counts(docs, leaf=100, fan=4, weights=(2, 5)).collect()
    goal = mix.targets([9000, 2400], [2, 5])
    for source, n, t in (("s", 3000, goal[0]), ("t", 600, goal[1])):
        mine = [r for r in got if r["source"] == source]
        assert len(mine) == n and abs(sum(r["taken"] for r in mine) - t) <= 4
    taken = mix.mix(docs, leaf=100, fan=4, weights=(2, 5)).groupBy("source").agg(F.sum("copies")).collect()
    assert {r[0]: r[1] for r in taken} == {s: sum(r["copies"] for r in got if r["source"] == s) for s in "st"}
    assert sorted(map(str, got)) == sorted(map(str, mix.mix_counts(docs.repartition(5), leaf=100, fan=4, weights=(2, 5)).collect()))


def test_targets_of_many_sources(spark, monkeypatch):
    """Beyond FEW_SOURCES targets come from tables; both ways agree."""
    rng = random.Random(5)
    texts = ["w " * rng.choice([1, 2, 30, 200]) for _ in range(400)]
    docs = docs_of(spark, texts, [rng.choice([*[f"s{i}" for i in range(40)], "é", None]) for _ in texts])
    few = mix.mix_counts(docs).collect()
    monkeypatch.setattr(mix, "FEW_SOURCES", 3)
    many = mix.mix_counts(docs).collect()
    key = lambda rows: sorted((r["doc_id"], str(r["source"]), r["source_size"], round(r["target"], 6)) for r in rows)
    assert key(few) == key(many)
    monkeypatch.setattr(mix, "FEW_SOURCES", -1)
    assert mix.mix_counts(docs.filter("false")).count() == 0
    assert {r["taken"] for r in mix.mix_counts(docs_of(spark, ["", None])).collect()} == {0}


def test_mix_query(spark, small):
    """Sizes, targets and limits by a plain computation; each source within one document of its target; reruns agree."""
    docs = [(r["doc_id"], len(words(r["text"])), r["source"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    names = sorted({s for _, _, s in docs if s is not None}) + ([None] if any(s is None for _, _, s in docs) else [])
    total = {n: sum(z for _, z, s in docs if s == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    goal, full = {}, set()
    while True:
        per = (sum(total.values()) - sum(3 * total[n] for n in full)) / sum(weight[n] for n in names if n not in full)
        goal = {n: 3 * total[n] if n in full else per * weight[n] for n in names}
        if not (more := {n for n in names if goal[n] > 3 * total[n]}):
            break
        full |= more
    rows = queries.op1_mix_sources(spark, small).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"]) for r in rows) == sorted((i, z, total[s]) for i, z, s in docs)
    source = {i: s for i, _, s in docs}
    for n in names:
        mine = [r for r in rows if source[r["doc_id"]] == n]
        assert all(math.isclose(r["target"], goal[n], rel_tol=1e-9) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - goal[n]) <= max(r["size"] for r in mine)
        rate = goal[n] / total[n]
        assert all(r["taken"] in {math.floor(rate) * r["size"], math.ceil(rate) * r["size"]} for r in mine)
    assert sorted(map(str, rows)) == sorted(map(str, queries.op1_mix_sources(spark, small).collect()))


def test_mix_odd(odd, none):
    assert mix.mix_counts(odd).count() == len(ODD)
    assert mix.mix_counts(none).count() == 0 == mix.mix(none).count()
    assert mix.mix(odd).columns == [*odd.columns, "_copies"]
    clash = odd.withColumns({c: F.lit(1) for c in ("_id", "_s", "_m", "_c", "_rows", "_p", "n", "rank", "tie")})
    assert mix.mix(clash).columns == [*clash.columns, "_copies"] and mix.mix(clash).count() == mix.mix(odd).count()


# 2. Decontamination


def brute_hits(text, items, n):
    w, hit, found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)), set(), set()
    for i, t in items:
        u = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        k = min(n, len(u))
        grams = {tuple(u[j : j + k]) for j in range(len(u) - k + 1)} if k else set()
        for j in range(len(w) - k + 1 if k else 0):
            if tuple(w[j : j + k]) in grams:
                hit |= set(range(j, j + k))
                found.add(str(i))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1 << 20, 12])
def test_contamination(spark, block):
    rng = random.Random(4)
    some = lambda m: rng.choice([" ", ". ", "-"]).join(rng.choice(["a", "B", "é", "c9"]) for _ in range(rng.randint(0, m)))
    items = [(i, some(7)) for i in range(6)] + [(9, None)]
    texts = [some(25) for _ in range(80)] + [None, ""]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(docs_of(spark, texts), bench, n=3, block_bytes=block).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["hit_items"]) for r in got} == {i: brute_hits(t, items, 3) for i, t in enumerate(texts)}


def test_decontaminate_modes(spark):
    bench = spark.createDataFrame([(1, "the secret answer is forty two")], "item_id long, text string")
    docs = docs_of(spark, ["Well: The SECRET answer, is forty-two indeed", "nothing here"])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, bench, mode="span").collect()}
    assert cut == {0: "Well: indeed", 1: "nothing here"}
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()] == [1]
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, bench, mode="x")


def test_contamination_odd(spark, odd, none):
    bench = spark.createDataFrame([(None, "one"), (None, None), (2, "")], "item_id long, text string")
    found = decontaminate.find_contamination(odd, bench)
    assert found.count() == len(ODD) and found.filter("n_hit > 0").count() == 2
    assert found.filter("size(hit_items) > 0").count() == 0
    assert decontaminate.decontaminate(odd, bench).columns == odd.columns
    assert decontaminate.find_contamination(none, bench).count() == 0
    assert decontaminate.find_contamination(odd, bench.filter("false")).filter("n_hit > 0").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["w", "é", "x1"]), st.sampled_from([1, 3, 15, 16, 17, 63, 64, 65, 130, 200])), min_size=1, max_size=12), st.integers(0, 300), st.sampled_from([" ", ". ", "\n"]))
def test_a_word_has_one_hash(parts, shift, gap):
    """Whatever stands before it and however the text is cut into pieces."""
    old = decontaminate._PIECE, decontaminate._LONG
    decontaminate._PIECE, decontaminate._LONG = 64, 16
    try:
        hasher = decontaminate.WordHasher()
        each = [(a * k).encode()[:k] if a != "é" else (a * k).encode() for a, k in parts]
        alone = [int(hasher.words(x)[0][0]) for x in each]
        data = b"p " * (shift // 2) + gap.encode().join(each)
        h, start, end = hasher.words(data)
        assert [data[s:e] for s, e in zip(start, end, strict=True)] == data.replace(b".", b" ").split()
        assert h[shift // 2 :].tolist() == alone
    finally:
        decontaminate._PIECE, decontaminate._LONG = old


@pytest.mark.parametrize("size", [(1 << 18) - 1, 1 << 18, (1 << 18) + 1, (1 << 19) + 5])
def test_words_of_any_length_are_hit(size):
    """A word around the size of a piece and of two, alone and after any text."""
    item = " ".join(["x" * size, *[f"w{i}" for i in range(9)]])
    grams = decontaminate.NgramSet.build([(1, item)], 10)
    shared = type("Shared", (), {"value": (grams.n, grams.bitmap, grams.items)})
    scan = decontaminate._scanner(shared, False, False)()
    got = scan([item, "a b " * 62_500 + item, "q " * 5 + item + " z", "x" * (size + 1) + item[size:], "é" * 70_000 + " " + item])
    assert got["n_hit"] == [10, 10, 10, 0, 10]


@pytest.mark.parametrize("few", [100_000, 0])
def test_blocks(spark, monkeypatch, few):
    """Long and repeated items, several blocks: the same as in one, by broadcast or not; texts are written in neither."""
    monkeypatch.setattr(decontaminate, "FEW_HITS", few)
    rng = random.Random(14)
    line = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    long = line(400)
    items = [(1, long), (2, long), *[(3, "x y z")] * 50, *[(i, line(rng.randint(2, 30))) for i in range(4, 30)]]
    cut = lambda t: " ".join(t.split()[rng.randrange(5) :][:25])
    texts = [rng.choice([line(20), "", " "]) + " " + cut(rng.choice(items)[1]) + " X-Y,z " + cut(rng.choice(items)[1]) for _ in range(60)] + [None, "", long + " " + long]
    texts += texts[:20]
    docs = docs_of(spark, texts).withColumn("n_hit", F.lit("own")).withColumn("th", F.lit("own"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    wrote, keep = [], materialize

    def spy(df, name="step"):
        wrote.append((name, df.columns))
        return keep(df, name)

    monkeypatch.setattr(decontaminate, "materialize", spy)
    got = decontaminate.find_contamination(docs, bench, block_bytes=2000)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "th", "n_words", "n_hit", "hit_items", "hit_spans"]
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["hit_items"]) for r in got.collect()} == {i: brute_hits(t, items, 10) for i, t in enumerate(texts)}
    assert len(wrote) > 3 and not any({"t", "text"} & set(c) for n, c in wrote if n != "items")
    one = decontaminate.find_contamination(docs, bench)
    assert {r["doc_id"]: r["hit_spans"] for r in one.collect()} == {r["doc_id"]: r["hit_spans"] for r in got.collect()}
    spans = [decontaminate.decontaminate(docs, bench, mode="span", **k).select("doc_id", "text").collect() for k in ({}, {"block_bytes": 2000})]
    assert sorted(spans[0]) == sorted(spans[1])


# 3. WARC


def test_warc_round_trip(spark):
    rng = random.Random(5)
    big = "".join(rng.choice("abcdefgh \n") for _ in range(700_000)) + "é"
    pages = [(1, "http://a/é x", "short"), (2, None, None), (3, "u", big), (4, "u", "z" * 1200), (5, "u", "z" * 1200), (5, "u", "z" * 1200), (None, "u", "z" * 1200), (7, "u", "y" * 999), (8, "u", "y" * 999), (None, "v", "q" * 3000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, size string")
    manifest = warc.archive(df)
    assert manifest.agg(F.sum("records")).first()[0] == len(pages)
    chunks = warc.read_chunks(manifest, chunk=4096)
    rows = chunks.collect()
    by_record = {}
    for r in rows:
        by_record.setdefault((r["file"], r["record"]), []).append(r)
    for got in by_record.values():
        got.sort(key=lambda r: r["chunk_no"])
        data = b"".join(r["data"] for r in got)
        assert all(len(r["data"]) <= 4096 for r in got) and [r["last"] for r in got] == [False] * (len(got) - 1) + [True]
        assert got[-1]["sha1"] == hashlib.sha1(data).hexdigest() and got[-1]["n_bytes"] == len(data)
        if got[0]["record_type"] == "response":
            assert data.decode() in {p[2] or "" for p in pages}
    found = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in warc.records_of(chunks).collect())
    want = []
    for i, _, t in pages:
        data = (t or "").encode()
        top = max((j for j, _, u in pages if (u or "") == (t or "") and j is not None), default=None)
        again = len(data) >= 1000 and top is not None and i != top
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", str(top if again else None)))
    assert found == sorted(want)
    assert "http://a/é x" in {r["uri"] for r in rows}
    assert warc.archive(df.filter("false")).count() == 0
    assert warc.read_chunks(warc.archive(df.filter("false"))).count() == 0


def test_query_streams_whole_payloads(spark, small, monkeypatch):
    seen, records_of = [], warc.records_of
    monkeypatch.setattr(warc, "records_of", lambda chunks: seen.append(chunks) or records_of(chunks))
    queries.op3_warc_chunks(spark, small)
    held = seen[0].groupBy("file", "record").agg(F.sum(F.length("data")).alias("held"), F.max("n_bytes").alias("n_bytes"))
    assert held.count() > 0 and held.filter(~F.col("held").eqNullSafe(F.col("n_bytes"))).count() == 0


def test_warc_spots_damage():
    import gzip
    import io

    good = gzip.compress(warc.header("response", 1, "u", "00", 3, 3, None) + b"abc\r\n\r\n")
    assert [r[3] for r in warc.read_stream(io.BytesIO(good * 2), chunk=2)] == [b"ab", b"c"] * 2
    with pytest.raises(ValueError):
        list(warc.read_stream(io.BytesIO(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))))


# 4. SimHash


def brute_print(text, k=3):
    w = words(lower(text))
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, tau):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= tau:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_by_the_contract(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["A", "bc", "d\n", "é"]) for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, ""]
    got = {r["doc_id"]: r for r in simhash.components_of(docs_of(spark, texts)).collect()}
    prints = [brute_print(t) for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{x:016x}" for x in prints]
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(prints, 2)
    assert brute_print(texts[0]) == simhash.majority(simhash.shingle_hashes(texts[0], 3)) % 2**64


def test_pieces_of_long_texts(monkeypatch):
    text = " ".join(str(i % 977) for i in range(3000))
    whole = simhash.majority(simhash.shingle_hashes(text, 3))
    monkeypatch.setattr(simhash, "_PIECE", 100)
    assert simhash.majority(simhash.shingle_hashes(text, 3)) == whole
    want = {xxhash.xxh64_intdigest(" ".join(text.split()[i : i + 5]).encode(), 42) for i in range(2996)}
    assert {x % 2**64 for x in simhash.shingle_set(text, 5)} == want


@pytest.mark.parametrize(("tau", "block"), [(2, 4096), (2, 2), (5, 4096), (5, 6)])
def test_links_within_tau(spark, tau, block):
    rng = random.Random(tau)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = set()
    for _ in range(150):
        x = rng.choice(base)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.choice([1, 5, 17, 18, 40, 41, 63, rng.randrange(64)])
        prints.add(x)
    signed = sorted(x - 2**64 if x >= 2**63 else x for x in prints)
    nodes = materialize(spark.createDataFrame([(x, x) for x in signed], "node long, fp long"))
    links = materialize(simhash.close_links(nodes, tau, block=block))
    roots = {r["node"]: r["root"] for r in graph.components(links).collect()}
    want = brute_components([x % 2**64 for x in signed], tau)
    assert [roots.get(x, x) for x in signed] == [signed[i] for i in want]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 20)), max_size=30), st.integers(1, 30))
def test_labels(pairs, cut):
    labels = np.arange(21)
    for i in range(0, len(pairs), cut):
        part = np.array(pairs[i : i + cut], dtype=np.int64)
        labels = common.join_labels(labels, part[:, 0], part[:, 1])
    want = list(range(21))
    for a, b in pairs:
        x, y = sorted((want[a], want[b]))
        want = [x if v == y else v for v in want]
    assert labels.tolist() == want


def test_groups_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(500).select(F.when(F.col("id") < 200, 5).otherwise(F.col("id") % 13).cast("long").alias("g"), "id")

        def fn(whole, starts):
            ends = np.append(starts[1:], whole.num_rows)
            return pa.RecordBatch.from_arrays([pa.array(whole.column("g").to_numpy()[starts]), pa.array(ends - starts)], names=["g", "n"])

        got = common.map_groups(df, "g", fn, "g long, n long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["g"]: r["n"] for r in got} == Counter(5 if i < 200 else i % 13 for i in range(500)) and len(got) == 13


def test_thresholds_cover():
    for tau in (0, 1, 2, 5, 8, 14):
        for n in (100, 10**6, 10**10):
            m = simhash.count_of_partitions(tau, n)
            widths = [len(p) for p in simhash.group_bits(np.eye(64), m)]
            ts = simhash.allocate(tau, widths, n, [n * n / 2**w for w in widths])
            assert sum(widths) == 64 and sum(ts) == tau - m + 1 and min(ts) >= -1
    assert simhash.allocate(2, [16, 16, 16, 16], 1000, [1e9, 1.0, 1.0, 1.0]) == [-1, 0, 0, 0]


def jaccard(a, b, k=5):
    def shingles(t):
        w = words(lower(t))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


@pytest.mark.parametrize("most", [100, 7, 2])
def test_connecting_large_groups(spark, most):
    """Groups of one part and of many: what connects within a group is what all pairs within reach connect, for crowds of like nodes, several of them, chains and nodes alone."""
    rng = random.Random(20)
    at = [*[rng.randrange(60) for _ in range(60)], *[1000 + rng.randrange(9) for _ in range(20)], *range(2000, 2200, 7), *range(5000, 9000, 250)]
    at = sorted(set(at))
    groups = {1: at, 2: at[::3], 3: [*range(2000, 2030, 7)], 4: [5]}
    members = materialize(spark.createDataFrame([(g, x, -(-len(xs) // most)) for g, xs in groups.items() for x in xs], "group long, node long, parts int"))
    payload = materialize(spark.createDataFrame([(x, [x + k for k in range(40)]) for x in at], "node long, set array<long>"))
    links = simhash.connect(members, payload, simhash._similar_in_groups(0.7), "long", most=most)
    near = lambda a, b: (40 - abs(a - b)) >= 0.7 * (40 + abs(a - b))
    want = {x: x for x in at}
    for xs in groups.values():
        for i, x in enumerate(xs):
            for y in xs[:i]:
                if near(x, y) and want[x] != want[y]:
                    a, b = sorted((want[x], want[y]))
                    want = {k: a if v == b else v for k, v in want.items()}
    roots = {r["node"]: r["root"] for r in graph.components(materialize(links)).collect()}
    assert {x: roots.get(x, x) for x in at} == want


@pytest.mark.parametrize("family", [2048, 3])
def test_near_copies(spark, monkeypatch, family):
    monkeypatch.setattr(simhash, "FAMILY", family)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(120)]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            other = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 8, 20])):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            texts.append(" ".join(other))
    texts += ["", None, " ", "tiny text", "tiny text", "tiny texts"]
    kept = {r["doc_id"] for r in simhash.near_dedup(docs_of(spark, texts)).collect()}
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert kept == {find(i) for i in range(len(texts))}


@pytest.mark.parametrize("block", [4096, 2])
def test_near_copies_of_any_shape(spark, block):
    """Truncated, appended to, a block swapped: contiguous edits move many bits of a fingerprint over words."""
    rng = random.Random(18)
    vocabulary = [f"w{i}" for i in range(3000)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = []
    for k in range(120):
        base = some(rng.randint(150, 400))
        n, b = len(base), rng.randint(10, 40)
        other = (base[: -(-n * 83 // 100)], base + some(n // 6), base[b : 2 * b] + base[:b] + base[2 * b :], base[: n // 2] + some(n // 12) + base[n // 2 + n // 12 :])[k % 4]
        texts += [" ".join(base), " ".join(other)]
    similar = {i for i in range(0, len(texts), 2) if jaccard(texts[i], texts[i + 1]) >= 0.8}
    assert len(similar) > 100
    kept = {r["doc_id"] for r in simhash.near_dedup(docs_of(spark, texts), block=block).collect()}
    assert kept == {i for i in range(len(texts)) if i - 1 not in similar}


def near_nodes(spark, texts):
    """Near prints of texts, materialised, by their place."""
    prints = simhash.NearPrints(simhash.NEAR_SHINGLE, simhash.band_rows(0.8))
    return materialize(spark.createDataFrame([(i, *prints(t)) for i, t in enumerate(texts)], T.StructType([T.StructField("node", T.LongType()), *simhash._NEAR])))


@pytest.mark.parametrize("block", [4096, 3])
def test_near_copies_by_pigeonhole(spark, monkeypatch, block):
    """Near-dedup's first candidates come by the pigeonhole over fingerprints: all pairs within reach and no others. Bands only look at what it leaves apart."""
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(200)]
        other = list(base)
        other[-1] = "other"
        texts += [" ".join(base), " ".join(other), " ".join(base[:166])]
    most = simhash.most_sketch_bits(0.8)
    nodes = near_nodes(spark, texts)
    close = materialize(simhash.print_links(nodes, block=block))
    rows = nodes.orderBy("node").collect()
    distinct = [sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) for h in ([xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in set(zip(*[words(t)[k:] for k in range(5)], strict=False))] for t in texts)]
    assert [r["fp"] % 2**64 for r in rows] == distinct
    near = lambda a, b: (distinct[a] ^ distinct[b]).bit_count() <= simhash.TAU
    want = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if near(a, b):
                low, high = sorted((want[a], want[b]))
                want = [low if x == high else x for x in want]
    roots = {r["node"]: r["root"] for r in graph.components(close).collect()}
    assert [roots.get(i, i) for i in range(len(texts))] == want
    assert sum(want[i + 1] == i for i in range(0, len(texts), 3)) > 20 and any(want[i + 2] != i for i in range(0, len(texts), 3))
    # Bands add links, and none where all is connected.
    assert {tuple(r) for r in close.collect()} < {tuple(r) for r in simhash.band_links(nodes, close, most, block=block).collect()}
    whole = materialize(spark.createDataFrame([(0, i) for i in range(1, len(texts))], "u long, v long"))
    assert simhash.band_links(nodes, whole, most, block=block).count() == whole.count()
    # Without bands the whole operator still finds what the pigeonhole does.
    monkeypatch.setattr(simhash, "band_links", lambda nodes, *links, **options: links[0])
    kept = {r["doc_id"] for r in simhash.near_dedup(docs_of(spark, texts), block=block).collect()}
    alike = list(range(len(texts)))
    for i in range(0, len(texts), 3):
        for a, b in ((i, i + 1), (i, i + 2), (i + 1, i + 2)):
            if want[a] == want[b] and jaccard(texts[a], texts[b]) >= 0.8:
                low, high = sorted((alike[a], alike[b]))
                alike[i : i + 3] = [low if x == high else x for x in alike[i : i + 3]]
    assert kept == set(alike) and len(kept) < len(texts) - 20


def test_bands():
    assert simhash.band_rows(0.8) == 6 and simhash.band_rows(0.5) == 2
    assert all((1 - s ** simhash.band_rows(s)) ** (256 // simhash.band_rows(s)) <= 1e-5 for s in (0.3, 0.5, 0.7, 0.8, 0.9))


def test_simhash_odd(odd, none):
    got = simhash.components_of(odd)
    assert got.count() == len(ODD)
    assert {r["component_id"] for r in got.filter("fingerprint = '0000000000000000'").collect()} == {1}
    assert simhash.components_of(none).count() == 0 == simhash.near_dedup(none).count()
    left = simhash.near_dedup(odd)
    assert left.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "3", "4", "6", "7", "None"]


# 5. Quality


def test_host_rates(spark):
    texts = ["too short"] * 40 + [" ".join(f"w{i}" for i in range(20))] * 60
    sources = ["bad"] * 38 + ["good"] * 2 + ["bad"] * 2 + ["good"] * 58
    got = quality.judge_quality(docs_of(spark, texts, sources), keep=["doc_id", "source", "text"]).collect()
    assert not any(r["kept"] for r in got if r["source"] == "bad") and sum(r["kept"] for r in got) == 58
    assert quality.keep_good(docs_of(spark, texts, sources)).count() == 58


def test_quality_against_sql_with_rejected_hosts(spark, tmp_path):
    """A table on which hosts, the null one among them, do fall; shrinkage spares one with a single document."""
    import duckdb
    from conftest import rows_of

    rng = random.Random(16)
    shares = {"junk": 0.97, "worse": 0.9, None: 0.95, "fair": 0.3, "clean": 0.0, "half": 0.6}
    rows = []
    for i in range(900):
        host = rng.choice(list(shares))
        bad = rng.random() < shares[host]
        rows.append((i, rng.choice(["short text", "a b c d e f " * 9, ""]) if bad else " ".join(rng.sample([f"w{k}" for k in range(99)], 25)), "en", host, 0))
    rows += [(2000, None, None, None, None), *rows[:40]]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLE["op5_quality_rules"])
    names, expected = [d[0] for d in want.description], want.fetchall()
    got = queries.op5_quality_rules(spark, str(tmp_path))
    assert rows_of(got.columns, got.collect()) == rows_of(names, expected)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judged = quality.judge_quality(docs, keep=["source"])
    fallen = {r["source"] for r in judged.filter("NOT base_failed AND NOT kept").collect()}
    assert fallen == {"junk", "worse", None}
    counts = spark.createDataFrame([*[(f"h{i}", 100, 60 + i) for i in range(10)], ("tiny", 1, 1)], "host string, n long, failed long")
    assert quality.host_verdicts(counts).filter("rejected").count() == 0
    left = quality.keep_good(docs)
    assert sorted(str(r["source"]) for r in left.collect()) == sorted(str(r["source"]) for r in judged.filter("kept").collect())


def test_quality_odd(odd, none):
    judged = quality.judge_quality(odd, max_host_rate=1.0)
    assert judged.count() == len(ODD) and judged.filter("kept").count() == 2
    good = quality.keep_good(odd, max_host_rate=1.0)
    assert good.columns == odd.columns and sorted(r["doc_id"] for r in good.collect()) == [4, 5]
    assert quality.judge_quality(none).count() == 0 == quality.keep_good(none).count()


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab \n#é", max_size=60))
def test_text_counts(text):
    w, lines = words(text), [x for x in text.split("\n") if words(x)]
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    assert quality.text_stats(text) == (len(w), sum(map(len, w)), text.count("#"), len(lines) - len(set(lines)), len(covered))


# 6. Language


def test_gradients():
    rng = np.random.default_rng(0)
    w = language.Weights.start(["a", "b", "c"], 4, rng)
    w.x, w.u, w.c, w.out, w.bias = [a.astype(float) for a in w.x], [a.astype(float) for a in w.u], [a.astype(float) for a in w.c], w.out.astype(float), w.bias.astype(float)
    codes, labels = rng.integers(97, 103, (6, 3)), np.array([0, 1, 2])
    _, grads = language.loss_and_gradients(w, codes, labels)
    for a, g in zip(w.arrays(), grads, strict=True):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, eps = a[i], 1e-3
        a[i] = old + eps
        up = language.loss_and_gradients(w, codes, labels)[0]
        a[i] = old - eps
        down = language.loss_and_gradients(w, codes, labels)[0]
        a[i] = old
        assert math.isclose(g[i], (up - down) / 2 / eps, rel_tol=1e-2)


def test_tagger_is_the_network():
    rng = np.random.default_rng(1)
    w = language.Weights.start(["a", "b"], 4, rng)
    text = bytes(rng.integers(97, 122, 100).tolist())
    codes = np.full((language.SEGMENT, 1), 256)
    codes[:100, 0] = np.frombuffer(text, dtype=np.uint8)
    both = np.concatenate([language._forward(w, d, codes)[0] for d in range(2)], axis=2)
    e = np.exp(both @ w.out + w.bias)
    want = (e / e.sum(axis=2, keepdims=True))[:100, 0].mean(axis=0)
    assert np.allclose(language.Tagger(w).documents([text, b""])[0], want, atol=1e-5)


def test_languages(spark, small):
    got = queries.op6_language_id(spark, small)
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd(spark, odd, none):
    weights = language.train(odd, steps=5)
    assert set(weights.langs) == {"de", "en", "fr"}
    got = language.identify(odd, weights)
    assert got.count() == len(ODD) and got.filter("lang_pred = 'und' and score = 0").count() == 3
    assert language.train(odd, steps=5).arrays()[0].tolist() == language.train(odd.repartition(3), steps=5, most_pieces=1000).arrays()[0].tolist()
    assert language.train(none) is None and language.identify(odd, None).filter("lang_pred = 'und'").count() == len(ODD)
    assert language.identify(none, weights).count() == 0


def test_very_many_languages(spark, monkeypatch):
    """Labels beyond FEW_LANGUAGES are joined, and segments labelled fewer at a time: nothing is refused."""
    rows = [(i, f"text {i} of language l{i % 40}", f"l{i % 40}", "s", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    few = language.train(docs, steps=3, per_language=5)
    monkeypatch.setattr(language, "FEW_LANGUAGES", 3)
    many = language.train(docs, steps=3, per_language=5)
    assert len(many.langs) == 40 and all((a == b).all() for a, b in zip(few.arrays(), many.arrays(), strict=True))
    whole = language.Tagger(many).documents([b"some text " * 300])
    monkeypatch.setattr(language, "CELLS", 1)
    assert language.Tagger(many).lanes == 16 and np.allclose(language.Tagger(many).documents([b"some text " * 300]), whole)


# 7. Chat


def brute_rotation(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted([(r[1] if r[1] is not None else -(10**9), r[2] or "unknown", r[3] or "") for r in rows if r[0] == conv])
        for who in {t[1] for t in turns} - {"system"}:
            text, mask = "", []
            for _, speaker, said in turns:
                role = "assistant" if speaker == who else "system" if speaker == "system" else f"user name={speaker.replace('<|im_', '< |im_')}"
                text += f"<|im_start|>{role}\n"
                body = said.replace("<|im_", "< |im_") + "<|im_end|>\n"
                if speaker == who:
                    mask.append((len(text), len(text) + len(body)))
                text += body
            out[conv, who] = (text, mask)
    return out


CHAT = "conv_id long, turn long, role string, text string"


def dialogues(got):
    """Texts and masks of each dialogue, its parts joined in order; each must begin where the one before ends."""
    out, sizes = {}, {}
    for r in sorted(got, key=lambda r: r["part"]):
        text, mask = out.get((r["conv_id"], r["speaker"]), ("", []))
        assert r["begin"] == len(text)
        out[r["conv_id"], r["speaker"]] = text + r["rendered"], mask + [tuple(m) for m in r["mask"]]
        sizes.setdefault((r["conv_id"], r["speaker"]), []).append(r["n_turns"])
    return out, sizes


def test_perspectives(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["ann", "bob", "☃", "system", None, "<|im_x"]), rng.choice(["hi", "", None, "é\n<|im_start|>x", "long " * 5])) for c in (1, 2, None) for t in range(12)]
    rows += [(3, 0, "system", "alone"), (4, None, "ann", "x"), (1, 3, "ann", "hi")]
    df = spark.createDataFrame(rows, CHAT).withColumns({c: F.lit("own") for c in ("speaker", "part", "begin", "mask", "n_turns", "rendered", "key", "who", "said", "turns", "at", "a", "n")})
    got = chat.rotate_perspectives(df).collect()
    assert {(r["conv_id"], r["speaker"]): (r["rendered"], [tuple(m) for m in r["mask"]]) for r in got} == brute_rotation(rows)
    assert chat.rotate_perspectives(df.filter("false")).count() == 0


def test_whole_dialogues(spark):
    """300 turns, and 4,000 equal ones beside others, are a row each for every participant; so is a conversation of one very long text."""
    rows = [(1, t, "ab"[t % 2], f"t{t}") for t in range(300)] + [(2, 5, "a", "same")] * 4000 + [(2, 7, "b", "other"), (2, None, "system", "first")] + [(3, 0, "a", LONG), (3, 1, "b", "short")]
    got = chat.rotate_perspectives(spark.createDataFrame(rows, CHAT)).collect()
    assert {(r["conv_id"], r["speaker"]): (r["rendered"], [tuple(m) for m in r["mask"]]) for r in got} == brute_rotation(rows) and {r["part"] for r in got} == {0}


def test_parts_join_to_the_dialogue(spark):
    """More turns or characters than a part holds: repeated turn numbers and rows, null turns, a null conversation."""
    rng = random.Random(12)
    rows = [(1, rng.randrange(6), rng.choice(["ann", "bob", "system", None, "<|im_x"]), f"x{rng.randrange(400)}") for _ in range(900)] + [(1, 3, "bob", "same")] * 5000
    rows += [(None, None, rng.choice("ab"), f"y{i}") for i in range(700)] + [(2, t % 128, "ab"[t % 2], f"z{t}") for t in range(512)] + [(3, t % 128, "ab"[t % 2], f"z{t}") for t in range(513)]
    rows += [(4, t, "abc"[t % 3], rng.choice(["", "w" * 50, "v" * 700])) for t in range(60)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CHAT)
    joined, sizes = dialogues(chat.rotate_perspectives(df, part_turns=512).collect())
    assert joined == brute_rotation(rows)
    assert sizes[1, "ann"] == [512] * 11 + [268] and sizes[None, "a"] == [512, 188] and sizes[2, "a"] == [512] and sizes[3, "a"] == [512, 1]
    joined, sizes = dialogues(chat.rotate_perspectives(df, part_turns=512, part_chars=1000).collect())
    assert joined == brute_rotation(rows) and len(sizes[4, "c"]) > 5


def test_parts_by_sql(spark, monkeypatch):
    """The registered SQL, with small parts, on a table whose conversations need them."""
    import duckdb
    from conftest import rows_of

    rng = random.Random(13)
    rows = [(rng.choice([1, 2, None]), rng.choice([None, *range(40)]), rng.choice(["ann", "bob", "system", None]), rng.choice(["", "é" * 30, "x", "same"])) for _ in range(500)]
    df = spark.createDataFrame(rows, CHAT)
    shown = chat.rotate_perspectives(df, part_turns=20, part_chars=200)
    monkeypatch.setattr(chat, "rotate_perspectives", lambda _: shown)
    monkeypatch.setattr(queries, "table", lambda *_: df)
    got = queries.op7_chat_rotation(spark, "")
    con = duckdb.connect()
    con.register("conversations", pa.Table.from_pylist([dict(zip(df.columns, r, strict=True)) for r in rows], schema=pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])))
    want = con.execute(queries.ORACLE["op7_chat_rotation"].replace(f"// {chat.PART_TURNS}", "// 20").replace(f"// {chat.PART_CHARS}", "// 200"))
    assert rows_of(got.columns, got.collect()) == rows_of([d[0] for d in want.description], want.fetchall())


# 8. Tokens


@pytest.fixture(scope="module")
def bpe():
    return tokens.WordBpe(queries.vocabulary_path())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from([*"abcdehimnorst ABΣςİßéÉ'.,!?_-|<>\n\t\r\x0b\x1c\x85\xa0　́̈123²Ⅷक한🎉‍﻿", "<|endoftext|>", "tion", "the "]), max_size=40).map("".join))
def test_counts_are_the_librarys(bpe, library, text):
    assert bpe.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_merging():
    ranks = {1 << 20 | 1: (0, 2), 2 << 20 | 1: (1, 3), 2 << 20 | 2: (2, 4)}
    assert [tokens.count_merges([1] * n, ranks) for n in range(7)] == [0, 1, 1, 1, 1, 2, 2]


def test_token_query(spark, small, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op8_token_counts(spark, small).collect()}
    for i, t in texts.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len(t.encode()), n > 2048)


def test_odd_vocabularies_are_refused(tmp_path):
    import json

    spec = json.load(open(queries.vocabulary_path(), encoding="utf-8"))
    for change in (lambda x: x["added_tokens"][0].update(content="[PAD]"), lambda x: x["normalizer"]["normalizers"][1].update(content="_"), lambda x: x["normalizer"]["normalizers"].pop()):
        other = json.loads(json.dumps({k: v for k, v in spec.items() if k != "model"})) | {"model": spec["model"] | {"merges": [], "vocab": {}}}
        change(other)
        (tmp_path / "v.json").write_text(json.dumps(other))
        with pytest.raises(ValueError):
            tokens.WordBpe(str(tmp_path / "v.json"))


def test_tokens_odd(odd, none):
    got = tokens.count_tokens(odd, queries.vocabulary_path())
    assert got.count() == len(ODD) and got.filter("n_tokens = 0").count() == 3
    assert tokens.count_tokens(none, queries.vocabulary_path()).count() == 0


# 9. Lines


def brute_cut(docs, window=3):
    where, keys = {}, sorted({(i is not None, i or 0, t) for i, t in docs if t is not None}, key=lambda k: k[:2])
    gone = {}
    for k in keys:
        lines = k[2].split("\n")
        full = [i for i, x in enumerate(lines) if words(x)]
        for j in range(len(full) - window + 1):
            g = tuple(lines[full[j + m]] for m in range(window))
            if where.setdefault(g, (k, j)) != (k, j):
                gone.setdefault(k, set()).update(full[j : j + window])
    cut = lambda k: "\n".join(x for i, x in enumerate(k[2].split("\n")) if i not in gone.get(k, ()))
    return [(i, None if t is None else cut((i is not None, i or 0, t))) for i, t in docs]


def test_lines(spark):
    rng = random.Random(10)
    texts = ["\n".join(rng.choice(["a", "b", "c c", "", " "]) for _ in range(rng.randint(0, 14))) for _ in range(60)] + [None, "", "a\na\na\na\na\na"]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
    assert got == dict(brute_cut(list(enumerate(texts))))


def test_lines_odd(odd, none):
    got = line_dedup.dedup_lines(odd)
    assert got.columns == odd.columns and got.count() == len(ODD)
    assert {r["text"] for r in got.filter("doc_id = 6").collect()} == {"x y\nz w\nv u"}
    assert line_dedup.dedup_lines(none).count() == 0


# 10. URLs


def test_hosts_by_posterior(spark):
    page = lambda i, h: (i, f"https://{h}/p{i}", "x", "y")
    pages = [page(i, "spam.example.net") for i in range(100)] + [page(100 + i, "fine.example.net") for i in range(100)] + [page(200, "new.example.org"), (201, None, "x", "y"), (202, "no scheme", "x", "y"), (None, "http://Spam.EXAMPLE.net/q?x#y", "x", "y"), page(5, "spam.example.net")]
    df = spark.createDataFrame(pages, "page_id long, url string, host string, n string")
    marks = spark.createDataFrame([(i, i < 100) for i in range(200)] + [(None, True), (3, None), (999, True), (5, False)], "page_id long, bad boolean")
    got = url_filter.judge_urls(df, marks, [])
    by = {(r["page_id"], r["host"]): r["verdict"] for r in got.collect()}
    assert got.count() == len(pages)
    assert all(v == ("block" if h == "spam.example.net" else "allow") for (_, h), v in by.items())
    assert (201, "") in by and (202, "") in by
    assert url_filter.judge_urls(df, marks.filter("false"), []).filter("verdict = 'block'").count() == 0
    assert url_filter.judge_urls(df.filter("false"), marks, []).count() == 0


def test_rules(spark):
    urls = {"https://example.com/en/5": "com/en/", "https://a.example.com/en/7": "example.com/en/7", "http://x.net/de/": "net/de/", "http://example.net/de/88": "example.net/de/8", "http://notexample.com/en/7": "com/en/", "http://org/es/": "org/es/", "http://org/ES/": None, "http://COM?/en/": None}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    got = {r["url"]: r["rule"] for r in df.select("url", url_filter.matching_rule(host, path, queries.RULES)["text"].alias("rule")).collect()}
    assert got == urls
    ties = [url_filter.Rule("block", "a.com", "/x"), url_filter.Rule("allow", "com", "/x/yz")]
    assert df.limit(1).select(url_filter.matching_rule(F.lit("a.com"), F.lit("/x/yz"), ties)["text"].alias("t")).first()["t"] == "com/x/yz"
    assert df.limit(1).select(url_filter.matching_rule(F.lit("a.com:80"), F.lit("/x"), ties)["text"].alias("t")).first()["t"] is None


def test_rules_in_blocks(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.com/{'en' if i % 2 else 'de'}/{i}") for i in range(40)], "page_id long, url string")
    rules = [url_filter.Rule("block" if i % 3 else "allow", f"h{i % 7}.com", path) for i, path in enumerate(["/", "/en/", "/de/", "/en/1", "/d"] * 3)] + queries.RULES
    marks = spark.createDataFrame([], "page_id long, bad boolean")
    once = sorted(map(str, url_filter.judge_urls(pages, marks, rules).collect()))
    monkeypatch.setattr(url_filter, "RULES_AT_ONCE", 4)
    assert sorted(map(str, url_filter.judge_urls(pages, marks, rules).collect())) == once


def test_beta_bounds():
    rng = np.random.default_rng(3)
    for a, b in ((0.5, 0.5), (2, 3), (30, 70), (1000, 5), (0.6, 3), (40_000, 60_000)):
        draws = rng.beta(a, b, 100_000)
        low = url_filter.beta_quantile(np.array([a]), np.array([b]), 0.05)
        assert abs((draws <= low[0]).mean() - 0.05) < 0.004
        assert abs(url_filter.beta_below(a, b, 0.5) - (draws <= 0.5).mean()) < 0.007
    grid = np.linspace(0.01, 0.99, 25)
    assert np.allclose(url_filter.beta_below(1, 4, grid), 1 - (1 - grid) ** 4, atol=1e-12)
    assert np.allclose(url_filter.beta_below(3, 1, grid), grid**3, atol=1e-12)


def test_registered_domains(spark):
    want = {
        "a.co.uk": ("a.co.uk", "co.uk"), "x.y.co.uk:8080": ("y.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "a.b.example.com": ("example.com", "com"), "user@www.example.org:80": ("example.org", "org"),
        "10.0.0.1": ("10.0.0.1", "#address"), "10.0.0.1:99": ("10.0.0.1", "#address"), "[::1]:80": ("[::1]", "#address"), "localhost": ("localhost", "localhost"), "": ("", ""),
        "p.me.ck": ("p.me.ck", "me.ck"), "a.www.ck": ("www.ck", "ck"), "z.github.io": ("z.github.io", "github.io"),
    }
    df = spark.createDataFrame([(h,) for h in want], "host string")
    both = url_filter.domain_and_suffix(url_filter.name_of(F.col("host")), [*url_filter.SUFFIXES, "*.ck", "!www.ck"])
    assert {r["host"]: (r[1], r[2]) for r in df.select("host", *both).collect()} == want
    plain = url_filter.domain_and_suffix(url_filter.name_of(F.col("host")), [])
    assert {r["host"]: r[1] for r in df.select("host", plain[0]).collect()}["a.co.uk"] == "co.uk"


def test_urls_against_sql_with_blocked_hosts(spark, tmp_path):
    """A table on which hosts do fall by reputation: few and many labels, ports, addresses, suffixes of two labels, repeated pages, very long urls."""
    import duckdb
    from conftest import rows_of

    rng = random.Random(15)
    shares = {"spam.example.net": 0.97, "www.spam.example.net": 0.9, "fine.example.net": 0.02, "new.spamfarm.co.uk": 1.0, "a.spamfarm.co.uk": 0.95, "b.spamfarm.co.uk:8080": 0.95, "shop.co.uk": 0.05, "10.0.0.7": 0.9, "10.0.0.8:81": 0.1, "half.example.org": 0.5, "x.github.io": 0.9, "y.github.io": 0.1}
    pages, labels = [], []
    for i in range(900):
        host = rng.choice([*shares, "spam.example.net", "fine.example.net"]) if i % 50 else rng.choice(["rare.spamfarm.co.uk", "lone.example.net"])
        pages.append((i, f"https://{host}/{rng.choice(['es', 'fr', 'de/8', 'en/7'])}/{i}", "x"))
        if rng.random() < 0.6 and host != "new.spamfarm.co.uk":
            bad = rng.random() < shares.get(host, 0.5)
            labels.append((i, 0 if bad else 1, int(rng.random() < 0.1)))
    pages += [(None, "http://spam.example.net/" + "p/" * 50_000, "x"), (1000, None, "x"), (1001, "no scheme", None), *pages[:30]]
    labels += [*labels[:20], (None, 0, 1), (5, None, 0), (99_999, 0, 0)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(queries.ORACLE["op10_url_filter"])
    names, rows = [d[0] for d in want.description], want.fetchall()
    got = queries.op10_url_filter(spark, str(tmp_path))
    assert rows_of(got.columns, got.collect()) == rows_of(names, rows)
    judged = {(r["host"], r["verdict"]) for r in got.filter("rule IS NULL").collect()}
    assert {("spam.example.net", "block"), ("a.spamfarm.co.uk", "block"), ("b.spamfarm.co.uk:8080", "block"), ("10.0.0.7", "block"), ("fine.example.net", "allow"), ("shop.co.uk", "allow"), ("10.0.0.8:81", "allow")} <= judged


def test_no_join_of_all_with_all(spark, small, capsys):
    queries.op10_url_filter(spark, small).explain("formatted")
    assert "NestedLoop" not in capsys.readouterr().out


# Shared


def test_shared_folder(spark, tmp_path):
    """Without spark.checkpoint.dir only a local session gets a folder of its own; what is written within ``temporary`` is gone after it."""
    import os
    from types import SimpleNamespace

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        common.shared_root(cluster)
    with common.temporary(spark):
        materialize(spark.range(5), "gone")
        path = common._written[-1][0]
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def test_skewed_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 4)
    left = spark.range(100).select(F.col("id"), F.when(F.col("id") < 60, 0).otherwise(F.col("id")).alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("w")).withColumn("v", F.col("k") + 1)
    got = skew_join(left, right, "k", "w")
    assert got.count() == 100 and got.filter("v = k + 1").count() == 100
    assert skew_join(left, right.filter("k < 70"), "k", "w", "inner").count() == 70
    assert skew_join(left, right.filter("false"), "k", "w").count() == 100


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40), st.sampled_from(["long", "string", "binary"]))
def test_components(spark, links, kind):
    """In one task and by rounds, for nodes of any type."""
    parent = list(range(31))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    name = {"long": lambda i: i, "string": lambda i: f"n{i:02d}", "binary": lambda i: bytes([200 + i])}[kind]
    want = {name(i): name(find(i)) for i in range(31) if find(i) != i}
    df = spark.createDataFrame([(name(a), name(b)) for a, b in links], f"u {kind}, v {kind}")
    few = graph.FEW_LINKS
    for most in (few, -1):
        graph.FEW_LINKS = most
        try:
            got = graph.components(df).collect()
        finally:
            graph.FEW_LINKS = few
        as_is = lambda x: bytes(x) if kind == "binary" else x
        assert {as_is(r["node"]): as_is(r["root"]) for r in got} == want
