"""Documents with everything awkward in them, and brute-force helpers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, fp string"


def documents(spark, *texts, ids=None, langs=None, sources=None):
    """Documents with clashing extra columns; ids are 0, 1, ... unless given."""
    n = len(texts)
    ids = list(range(n)) if ids is None else ids
    langs, sources = langs or ["en"] * n, sources or ["s"] * n
    rows = [(i, t, la, s, len(t or ""), "r", "f") for i, t, la, s in zip(ids, texts, langs, sources)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Nulls in every column, empty, blank, very long and repeated texts, repeated rows."""
    texts = [None, "", " \n\t", "one", "One", "one", "a b c d e " * 3000, "x" * 200_000,
             "␛ </s>[INST] ok", "über ünï 你好 🤖 \x00", "one", None]
    ids = [0, 1, 2, 3, 4, 3, 6, 7, 8, 9, None, None]
    langs = [None, "en", "en", "en", "de", "en", None, "de", "fr", "fr", "en", None]
    sources = [None, "a", "b", "b", "b", "b", "a", "a", None, "c", "b", None]
    return documents(spark, *texts, ids=ids, langs=langs, sources=sources)


def words(rng: random.Random, n: int, of=("aa", "bb", "cc", "dd", "ee")) -> str:
    return " ".join(rng.choice(of) for _ in range(n))
