import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from plantloom.llm import quality_ordinal as qo
from tests.llm.cases import awkward, documents


def test_fit_orders_grades():
    rng = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(900):
        grade = int(rng.integers(3))
        rows.append(np.unique(np.r_[rng.integers(100, 200, 5), grade]).astype(np.int32))
        grades.append(grade)
    model = qo.fit(rows, np.array(grades))
    assert np.all(np.diff(model.thresholds) > 0)
    assert model.weights[0] < model.weights[1] < model.weights[2]
    p = model.probabilities(model.score([np.array([g], np.int32) for g in range(3)]))
    assert np.allclose(p.sum(axis=1), 1) and list(p.argmax(axis=1)) == [0, 1, 2]


def plain_features(text):
    """Names of features by definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return set()
    names = []
    for w in re.findall(r"[^\W\d_]+", text):
        w = w.lower()
        names += ["w:" + w] + ["p:" + w[:k] for k in (3, 4, 5, 6, 7) if k < len(w)]
    slots = [xxhash.xxh32_intdigest(n) % qo.FEATURES for n in names]
    twice = {s for s, n in Counter(slots).items() if n > 1}
    out = set(slots) | {qo.FEATURES + s for s in twice}
    lines = [x for x in text.split("\n") if x.strip()]
    shares = {"upper": sum(w.isupper() for w in words), "alone": sum(not w[0].isalnum() for w in words),
              "marked": sum(len(w) > 1 and not w[-2:].isalnum() for w in words),
              "double": sum(words[i] == words[i + 1] for i in range(len(words) - 1))}
    marks = [f"s:{n}:{k}" for n, v in shares.items() for k in range(1, 11) if v / len(words) >= k / 10 - 1e-12]
    marks += [f"d:{k}" for k in range(1, 11) if 10 * (len(lines) - len(set(lines))) >= k * len(lines)]
    return out | {xxhash.xxh32_intdigest(m) % qo.FEATURES for m in marks}


def test_whole_result_by_definition(spark):
    """Features, their choice and every document's probabilities on a whole table, without Spark."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    graded = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        grade = 0 if r.toxic else 1 if r.quality == 0 else 2
        if r.doc_id in docs and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            graded[r.doc_id] = min(grade, graded.get(r.doc_id, grade))
    made = {i: plain_features(t) for i, t in docs.items()}
    rows = [[i for i in graded if graded[i] == k] for k in range(3)]
    chosen = set()
    for f in set().union(*(made[i] for i in graded)):
        table = [(sum(f in made[i] for i in r), len(r)) for r in rows]
        share, g = sum(a for a, _ in table) / len(graded), 0.0
        for a, n in table:
            g += sum(2 * x * math.log(x / e) for x, e in ((a, n * share), (n - a, n * (1 - share))) if x)
        chosen |= {f} if g >= qo.EVIDENCE else set()
    assert 0 < len(chosen) <= qo.MOST_FEATURES
    ids = sorted(graded)
    model = qo.fit([np.array(sorted(made[i] & chosen), np.int32) for i in ids], np.array([graded[i] for i in ids]))
    got = qo.op6_quality_ordinal(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        x = sum(model.weights[f] for f in made[r.doc_id])
        below = [1 / (1 + math.exp(x - t)) for t in model.thresholds]
        assert abs(r.tail_probability - (1 - below[1])) < 1e-6
        assert abs(r.expected_grade - (2 - below[0] - below[1])) < 1e-6
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_gradient_and_optimum():
    rng = np.random.default_rng(3)
    grades = rng.integers(0, 3, 60)
    rows = [np.unique(np.r_[rng.integers(3, 12, 3), g if rng.random() < 0.7 else 3]).astype(np.int32) for g in grades]
    columns, owner = np.concatenate(rows), np.repeat(np.arange(60), [len(r) for r in rows])
    weight = np.array([0.5, 1.0, 1.5])[grades]
    param = rng.normal(0, 0.3, 12 + 2)
    _, grad = qo.objective(param, columns, owner, grades, weight)
    for k in range(len(param)):
        step = np.eye(len(param))[k] * 1e-6
        up, down = (qo.objective(param + s, columns, owner, grades, weight)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - grad[k]) < 1e-6
    # plain descent, long enough to arrive
    one = np.ones(60)
    for _ in range(20_000):
        param = param - 0.5 * qo.objective(param, columns, owner, grades, one)[1]
    model = qo.fit(rows, grades)
    mine = np.r_[model.weights[:12], model.thresholds[0], np.log(np.diff(model.thresholds))]
    loss, best = (qo.objective(p, columns, owner, grades, one)[0] for p in (mine, param))
    assert best <= loss + 1e-9 and loss < best + 0.01


def test_held_out_grades(spark):
    """Toxic and poor documents go in every language, good ones stay."""
    sf = "/root/testdata/sf0.1"
    langs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = qo.op6_quality_ordinal(spark, sf).join(
        qo.grades_of(spark.read.parquet(f"{sf}/labels.parquet")), "doc_id").join(langs, "doc_id").filter("held_out")
    kept = {(r.lang, r.grade): r.kept for r in got.groupBy("lang", "grade").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    for lang in ("en", "de", "es", "fr"):
        assert kept[lang, 2] > 0.97 and kept[lang, 1] < 0.4 and kept[lang, 0] < 0.2, (lang, kept)


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (6, 1, 1), (None, 1, 0), (7, None, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, qo.grades_of(labels).collect())) == [(3, 1), (6, 0), (99, 2)]
    for some in (labels, labels.limit(0)):
        model = qo.learn(docs, some)
        got = docs.select(qo.scorer(spark, model)("text").alias("s")).collect()
        assert len(got) == 12 and all(0 <= r.s.expected_grade <= 2 for r in got)
    assert np.allclose(qo.fit([], np.array([], np.int64)).thresholds, [np.log(1 / 2), np.log(2)])
    assert documents(spark).select(qo.scorer(spark, model)("text").alias("s")).count() == 0


def test_rare_toxic_rows_of_each_language(spark):
    """Markers in fewer than twenty rows each, in a sample far smaller than the table."""
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(3000):
        lang = "xyz"[i % 3]
        toxic = i % 100 < 3  # a hundredth of each language
        words = [f"{lang}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in rng.integers(0, 200, 25)]
        texts.append(" ".join(words + [f"{lang}bad", f"{lang}vile", f"{lang}foul"] * toxic))
        labels.append((i, 1, int(toxic)))
    docs = documents(spark, *texts)
    model = qo.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), fit_rows=600)
    got = docs.select("doc_id", qo.held_out("doc_id").alias("held_out"),
                      qo.scorer(spark, model)("text").alias("s")).filter("held_out").collect()
    for lang in range(3):
        toxic = [r.s.tail_probability for r in got if r.doc_id % 3 == lang and r.doc_id % 100 < 3]
        good = [r.s.tail_probability for r in got if r.doc_id % 3 == lang and r.doc_id % 100 >= 3]
        assert toxic and max(toxic) < min(good), lang
        assert np.mean(np.array(toxic) < qo.KEEP_FROM) > 0.5, lang


def test_quotas():
    assert qo.quotas(np.array([10, 500, 9000]), 900) == [10, 445, 445]
    assert qo.quotas(np.array([10, 50, 90]), 900) == [10, 50, 90] and qo.quotas(np.zeros(3, int), 9) == [0] * 3
