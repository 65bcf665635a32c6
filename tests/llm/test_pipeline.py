"""The pipeline's stages, one after the other, against brute force on a small table."""

import math
import random

import pytest
from pyspark.sql import functions as F
from test_text_operators import brute_cut, brute_hits, jaccard, words

import corpus_pipeline
from fairlead.llm import mix
from fairlead.llm.common import materialize
from fairlead.llm.quality import text_stats


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """(folder, documents): copies, near copies, repeated passages, benchmark passages, junk, nulls."""
    rng = random.Random(12)
    vocabulary = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "ei", "o", "un", "ast")]
    line = lambda n=14: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [line(20) for _ in range(4)]
    boiler = [line() for _ in range(4)]
    docs = []
    for i in range(120):
        text = [line() for _ in range(rng.randint(2, 9))]
        kind = i % 10
        if kind == 1:
            text[1:1] = boiler
        if kind == 2:
            text.append(items[i % 4])
        if kind == 3:
            text = docs[i - 2][1].split("\n")[-2:]
        if kind == 4:
            text = [line(3)]
        if kind == 5:
            text = [line(40)]
        if kind == 6:
            text = [docs[i - 1][1].rsplit(" ", 1)[0] + " other"]
        if kind == 7:
            text = [docs[i - 2][1]]
        if kind == 8:
            text = [line(6)] * 6
        docs.append((i, "\n".join(text), "en", rng.choice("aab"), 0))
    docs += [(None, None, None, None, None), (500, "", "en", "a", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, list(enumerate(items))


def test_stages(spark, corpus):
    folder, docs, items = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns, now = frame.columns, [(d[0], d[1]) for d in docs]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "mix_sources"]

    def step(name, want):
        nonlocal frame
        frame = spark.createDataFrame(stages[name](spark, frame, folder).collect(), frame.schema)
        assert frame.columns == columns
        got = sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)
        assert got == sorted(want, key=str)
        return want

    good = lambda t: (s := text_stats(t))[0] >= 10 and 100 * s[4] <= 20 * s[0]
    now = step("quality_rules", [d for d in now if good(d[1])])
    now = step("line_dedup", [(i, t) for i, t in brute_cut(now) if words(t)])
    parent = list(range(len(now)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(now)):
        for j in range(i):
            if jaccard(now[i][1], now[j][1]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    before = len(now)
    now = step("near_dedup", [now[i] for i in sorted({find(i) for i in range(len(now))})])
    assert len(now) < before
    before = len(now)
    now = step("decontaminate", [d for d in now if not brute_hits(d[1], items, 10)[1]])
    assert len(now) < before
    mixed = stages["mix_sources"](spark, frame, folder).collect()
    left = dict(now)
    assert {r["doc_id"] for r in mixed} <= set(left) and all(1 <= r["copies"] <= 3 and r["text"] == left[r["doc_id"]] for r in mixed)
    total = sum(len(words(t)) for t in left.values())
    assert abs(sum(r["copies"] * len(words(r["text"])) for r in mixed) - total) <= 3 * max(len(words(t)) for t in left.values())


def test_run(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus[0])
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies"] and rows.count() > 0
    assert all(r["n_chars"] == len(r["text"]) for r in rows.collect())


ODD = [
    (None, None, None, None, None),
    (1, "", "en", "s", 0),
    (2, " \n\t ", "en", "s", 4),
    *[(3, " ".join(f"w{i}" for i in range(30)), None, "s", 0)] * 4,
    (4, " ".join(f"w{i}" for i in range(30)), "en", None, 0),
    (None, " ".join(f"u{i}" for i in range(40)), "en", "t", 0),
    (None, " ".join(f"u{i}" for i in range(40)), "en", "t", 0),
    (6, "\n".join(" ".join(f"{c}{i}" for c in "abcdefgh") for i in range(9)), "fr", "t", 0),
    (7, " ".join(f"v{i % 60_000}" for i in range(120_000)), "fr", "t", 0),
]
CLASHING = ["copies", "node", "fp", "first", "root", "host", "n_words", "n_hit", "base_failed", "at", "id", "_c0", "_c1", "_id", "_m", "_p", "key", "_text", "_in", "group", "parts"]


@pytest.fixture(scope="module")
def odd_corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({c: F.lit("own") for c in CLASHING}).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_on_odd_tables(spark, odd_corpus):
    """Nulls, repeated rows, empty and very long texts, extra columns with names that stages use: no stage changes or loses a column, copies go, the rest stays."""
    docs = spark.read.parquet(f"{odd_corpus}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, odd_corpus), name)
        assert docs.columns == (columns if name != "mix_sources" else [*columns, "_copies"])
        assert docs.filter("copies = 'own' AND node = 'own' AND _p = 'own'").count() == docs.count()
        if name == "quality_rules":
            assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["3", "3", "3", "3", "4", "6", "None", "None"]
        if name in ("near_dedup", "decontaminate"):
            assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["3", "6", "None"]
    assert {str(r["doc_id"]) for r in docs.collect()} <= {"3", "6", "None"}


def test_stages_on_an_empty_table(spark, odd_corpus):
    docs = spark.read.parquet(f"{odd_corpus}/documents.parquet").filter("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, odd_corpus), name)
        assert docs.count() == 0 and set(docs.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}


def test_mixing_by_expectation(spark, corpus):
    """The last stage against a plain computation: every document's copies are the whole numbers around its source's rate, and each source's words lie within one document of its target."""
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").filter("doc_id IS NOT NULL")
    rows = docs.collect()
    size = {r["doc_id"]: len(words(r["text"])) for r in rows}
    names = sorted({r["source"] for r in rows})
    total = {n: sum(size[r["doc_id"]] for r in rows if r["source"] == n) for n in names}
    goal = dict(zip(names, mix.targets([total[n] for n in names], [mix.WEIGHTS[i % 3] for i in range(len(names))]), strict=True))
    got = {r["doc_id"]: r["copies"] for r in corpus_pipeline.mix_sources(spark, docs, corpus[0]).collect()}
    for n in names:
        mine = [r["doc_id"] for r in rows if r["source"] == n]
        rate = goal[n] / total[n]
        assert all(got.get(i, 0) in {math.floor(rate), math.ceil(rate)} for i in mine if size[i])
        assert abs(sum(got.get(i, 0) * size[i] for i in mine) - goal[n]) <= max(size[i] for i in mine)
