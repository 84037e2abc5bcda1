import re

from plantloom.llm import exact_dedup as ed
from tests.llm.cases import awkward, documents


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(normal(r.text), []).append(r.doc_id)
    got = ed.decisions(docs).collect()
    assert len(got) == len(rows)
    keep = {}
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        for i in ids:
            keep.setdefault((i, min(known, default=None), len(ids)), 0)
            keep[i, min(known, default=None), len(ids)] += 1
    found = {}
    for r in got:
        key = (r.doc_id, r.keep_id, r.group_size)
        found[key] = found.get(key, 0) + 1
    assert found == keep
    # exactly one row per group stays, the smallest id
    kept = [(r.digest, r.doc_id, r.keep_id) for r in got if r.kept]
    assert len(kept) == len({d for d, _, _ in kept}) == len(groups)
    assert all(a == b for _, a, b in kept)
    stays = ed.keep_first(docs)
    assert stays.columns == docs.columns and stays.count() == len(groups)


def test_awkward_rows(spark):
    check(awkward(spark))
    assert ed.decisions(documents(spark)).count() == ed.keep_first(documents(spark)).count() == 0


def test_frequent_texts(spark):
    texts = ["copy  of one" if i % 3 else "copy of one" for i in range(400)]
    texts += [f"text {i % 150}" for i in range(300)] + [None] * 50
    docs = documents(spark, *texts, ids=[(7 * i) % 750 for i in range(750)]).repartition(5)
    check(docs)
    slim = docs.select(ed.digest_of(docs["text"]).alias("digest"))
    found = {r.digest for r in ed.frequent(slim).collect()}
    assert len(found) <= 1 / ed.SHARE
    heavy = slim.groupBy("digest").count().filter(f"count > {ed.SHARE * 750}").collect()
    assert {r.digest for r in heavy} <= found and len(heavy) >= 2


def test_no_python_in_the_plan(spark):
    plan = ed.decisions(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
