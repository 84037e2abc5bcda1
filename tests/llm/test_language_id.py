import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from plantloom.llm import language_id as li
from tests.llm.cases import awkward, documents


def plain(text):
    """Trigrams by definition."""
    low = (text or "").lower()
    at = lambda i: low[i] if 0 <= i < len(low) and low[i].isalpha() else " "
    return [at(i - 1) + c + at(i + 1) for i, c in enumerate(low) if c.isalpha()]


def spelt(gram):
    return "".join(chr(int(gram) >> s & (1 << 21) - 1) for s in (42, 21, 0))


def test_trigrams_by_definition(monkeypatch):
    texts = ["Ab c!", None, "", "12", "é", "straße İx", "word " * 50]
    for chunk in (1 << 19, 3):  # long texts in parts
        monkeypatch.setattr(li, "CHUNK", chunk)
        found = {i: [] for i in range(len(texts))}
        for owner, grams in li.trigrams(texts):
            for o, g in zip(owner, grams):
                found[o].append(spelt(g))
        assert found == {i: plain(t) for i, t in enumerate(texts)}


def test_filters_against_exact_sets():
    rng = np.random.default_rng(1)
    known = {n: rng.integers(0, 1 << 62, 20_000) for n in ("b", "a", "c")}
    filters = li.LanguageFilters.of(known)
    assert filters.languages == ("a", "b", "c")
    for i, name in enumerate(filters.languages):
        hit = filters.containing(known[name])[:, 0] >> np.uint64(i) & np.uint64(1)
        assert hit.all()  # nothing that was put in is missed
        other = filters.containing(rng.integers(0, 1 << 62, 50_000))[:, 0] >> np.uint64(i) & np.uint64(1)
        assert abs(other.mean() - filters.false_positive[i]) < 0.002


def test_held_out_accuracy(spark):
    found = li.op1_language_id(spark, "/root/testdata/sf0.01").alias("p").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, least, most, n = found.filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"),
        F.count("*")).first()
    assert n > 200 and right > 0.97 and 0 <= least <= most <= 1


def test_awkward_rows(spark):
    docs = awkward(spark)
    predict = li.predictor(spark, li.learn(docs))
    got = docs.select("doc_id", "text", predict("text").alias("p")).collect()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.p.lang != "und") == letters and 0 <= r.p.score <= 1
    empty = documents(spark)
    assert li.learn(empty).languages == ()
    none = li.predictor(spark, li.learn(empty))
    assert {tuple(r.p) for r in docs.select(none("text").alias("p")).collect()} == {("und", 0.0)}


def test_predictions_by_definition(spark):
    """Every document's scores from exact sets of trigrams; the filters differ by their false positives only."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    counts = {}
    for r in docs:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            counts.setdefault(r.lang, Counter()).update(plain(r.text))
    known = {k: {g for g, n in c.items() if n >= li.MIN_RATE * c.total()} for k, c in counts.items()}
    got = {r.doc_id: r for r in li.op1_language_id(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for r in docs:
        grams = plain(r.text)
        share = {k: sum(g in s for g in grams) / max(len(grams), 1) for k, s in known.items()}
        best = max(sorted(share), key=share.get)
        assert abs(got[r.doc_id].score - share[best]) < 0.01
        if grams and share[best] - max([0.0, *(v for k, v in share.items() if k != best)]) > 0.02:
            assert got[r.doc_id].lang_pred == best


def test_a_language_left_out_is_refused(spark):
    """Filters and floors of the other languages refuse its documents and keep their own, learnt from or not."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").cache()
    for out in ("de", "en", "es", "fr"):
        rest = docs.filter(F.col("lang") != out)
        filters = li.learn(rest.filter(~li.held_out("doc_id")))
        least = li.floors(rest, filters)
        assert sorted(least) == sorted({"de", "en", "es", "fr"} - {out})
        known = docs.select("lang", li.recognizer(spark, filters, least)("text").alias("known"))
        foreign, own = known.agg(F.avg(F.when(F.col("lang") == out, F.col("known").cast("int"))),
                                 F.min(F.when(F.col("lang") != out, F.col("known").cast("int")))).first()
        assert foreign < 0.1 and own == 1, (out, foreign, least)


def test_floors_of_awkward_rows(spark):
    docs = awkward(spark)
    filters = li.learn(docs)
    for rows in (docs, documents(spark)):
        least = li.floors(rows, filters)
        assert set(least) == set(filters.languages) and all(0.25 <= v <= 1 for v in least.values())
        for r in docs.select("text", "lang", li.recognizer(spark, filters, least)("text").alias("known")).collect():
            letters = any(c.isalpha() for c in r.text or "")
            assert letters if r.known else not letters or r.lang is None
    nothing = li.learn(documents(spark))
    assert li.floors(docs, nothing) == {}
    assert docs.select(li.recognizer(spark, nothing, {})("text").alias("known")).filter("known").count() == 0
