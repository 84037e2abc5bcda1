"""Phrases against counting everything by hand."""

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from plantloom.llm import phrases
from plantloom.llm.phrases import PLAIN, collocations, frequent_phrases, op11_phrases
from plantloom.llm.tables import read
from tests.llm.cases import awkward, documents, words

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows, longest=4):
    """Every phrase's count, per language, and all words."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            found = re.findall("[^ \t]+", piece)
            total[lang] += len(found)
            for k in range(1, longest + 1):
                for i in range(len(found) - k + 1):
                    counts[lang, tuple(found[i:i + k])] += 1
    return counts, {k: n for k, n in total.items() if n}


def ranked(counts, total, least, per_lang):
    often = {p: n for p, n in counts.items() if n >= least and len(p[1]) > 1}
    rows = []
    for (lang, phrase), a in often.items():
        if any(lang == other and len(longer) > len(phrase) and 100 * n >= 80 * a
               and any(longer[i:i + len(phrase)] == phrase for i in range(len(longer)))
               for (other, longer), n in often.items()):
            continue
        cuts = [(2000000 * a // (counts[lang, phrase[:k]] + counts[lang, phrase[k:]]), k,
                 counts[lang, phrase[:k]], counts[lang, phrase[k:]]) for k in range(1, len(phrase))]
        score, _, left, right = min(cuts)
        rows.append((lang, " ".join(phrase), a, left, right, total[lang], score))
    out = []
    for lang in total:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i, *r[1:]) for i, r in enumerate(mine[:per_lang], 1)]
    return sorted(out)


def corpus(spark):
    rng, of = random.Random(5), [f"w{i}" for i in range(9)]
    texts = []
    for i in range(120):
        text = words(rng, rng.randrange(60), of)
        texts.append(re.sub("w[1-4] ", lambda m: rng.choice([m[0], m[0].upper(), m[0].rstrip() + ", ", m[0] + "\t "]), text)
                     + (" The quick Brown fox jumps. over" if i % 3 == 0 else ""))
    texts += [None, "", " \t ", ".,;", "über ÜBER über ünï", "a\x00b a\x00b", texts[0], texts[0]]
    langs = [["en", "de", None, "und"][i % 4] for i in range(len(texts))]
    return documents(spark, *texts, langs=langs), list(zip(langs, texts))


@pytest.mark.parametrize("shards, least, slots", [(2, 5, 1 << 26), (3, 12, 1 << 10), (4, 30, 64)])
def test_counts_equal_brute_force(spark, shards, least, slots):
    docs, rows = corpus(spark)
    often, total = frequent_phrases(docs, least=least, shards=shards, slots=slots)
    counts, by_lang = counted(rows)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in often.collect()}
    assert got == {p: n for p, n in counts.items() if n >= least}
    assert {r.lang: r.n for r in total.collect()} == by_lang
    if least >= 5:
        found = collocations(often, total, per_lang=7)
        assert sorted(tuple(r) for r in found.collect()) == ranked(counts, by_lang, least, 7)


def test_phrases_wait_for_both_parts_and_stop_after_a_cycle(spark, monkeypatch):
    """What the steps emit: words in the first cycle, longer ones later, nothing twice."""
    docs, rows = corpus(spark)
    folder = []
    real = phrases.scratch_folder
    monkeypatch.setattr(phrases, "scratch_folder", lambda s: folder.append(real(s)) or folder[0])
    monkeypatch.setattr(phrases, "remove", lambda *_: None)
    frequent_phrases(docs, least=12, shards=3)
    steps = len(list(Path(folder[0].removeprefix("file:")).glob("counts/step=*")))
    lengths, seen, first = [], set(), {}
    for step in range(steps):
        part = spark.read.schema(phrases.COUNTS).parquet(f"{folder[0]}/counts/step={step}").collect()
        lengths.append({r.k for r in part})
        for r in part:
            assert r.since <= step < r.since + 3
            assert first.setdefault((r.lang, r.phrase), r.since) == r.since
    assert lengths[0] == {1} and lengths[1] >= {1, 2} and 1 not in set().union(*lengths[3:])
    assert any({2, 3} <= k for k in lengths) and any(4 in k for k in lengths) and steps <= 12


def test_long_texts_are_cut_at_breaks(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 50)
    rng = random.Random(2)
    texts = [words(rng, 200).replace("ee", "ee,").encode(), b"x" * 500, b""]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 3, "text": pa.array(texts, pa.binary())})
    blocks = [data for _, data in phrases._blocks(iter([batch]))]
    whole = b"".join(t.translate(PLAIN) + b"\n" for t in texts)
    assert len(blocks) > 5 and sorted(b"".join(blocks).split(b"\n")) == sorted(whole.split(b"\n"))
    assert all(data.endswith(b"\n") for data in blocks)


def test_filters_pass_what_they_hold(spark):
    rows = [("en", bytearray(f"a{i} b{i % 7} c".encode())) for i in range(500)] + [("de", bytearray(b"a"))]
    found = phrases._set_slots(spark.createDataFrame(rows, "lang string, phrase binary"), 1 << 13)
    filled = np.where(found, np.uint8(3), np.uint8(phrases.NEVER))

    def hashed(lang, phrase):
        x = phrases._hashes([lang.encode()])
        for w in phrase.split(b" "):
            x = phrases._extended(x, phrases._hashes([w]))
        return x[0]

    assert (phrases.since(filled, np.array([hashed(la, bytes(p)) for la, p in rows])) == 3).all()
    others = np.array([hashed("en", f"a{i} b".encode()) for i in range(2000)])
    assert (phrases.since(filled, others) == 3).mean() < 0.1


def test_awkward_documents(spark):
    docs = awkward(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    counts, by_lang = counted(rows)
    often, total = frequent_phrases(docs)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in often.collect()} == {
        p: n for p, n in counts.items() if n >= 30}
    assert sorted(tuple(r) for r in collocations(often, total).collect()) == ranked(counts, by_lang, 30, 2000)


def test_empty_table(spark, tmp_path):
    awkward(spark).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_phrases(spark, str(tmp_path))
    assert got.count() == 0
    assert dict(got.dtypes) == {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint",
                                "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"}


def test_scores_beyond_64_bits(spark):
    big = 10 ** 16
    often = spark.createDataFrame(
        [("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big), ("en", 2, "a b", 2 * big - 1)],
        "lang string, k int, phrase string, n long")
    total = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    row = collocations(often, total).first()
    assert row.score == 2000000 * (2 * big - 1) // (5 * big) == 799999
