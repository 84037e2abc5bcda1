"""Language identification by bit-sliced Bloom filters over character trigrams.

A language's filter holds the trigrams that make up at least ``min_rate`` of its
training text, so it holds at most ``1 / min_rate`` of them however large the
corpus. All filters share their slots: a slot is a bitmask of languages, and the
conjunction of a trigram's slots names all languages that contain it. Per
language, the share of a text's trigrams with its bit set, corrected for the
filter's false positives, decides.

A trigram is centred on a letter (lower case); a neighbour that is no letter
counts as a space. A text thus has one trigram per letter.

Defined results: null text, or text without a letter: ``und``, score 0. A text
whose trigrams no filter knows, and any tie: the first language by code point,
score 0 for the former. Nothing learnt (empty table, no labels): ``und``, 0.
Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.tables import quoted, read, ready_for_python
from plantloom.session import materialize

UND = "und"
MIN_RATE = 2e-5
SLOTS_LOG2 = 20
HASHES = 3
# A text in none of the learnt languages shares few of their trigrams, at any table.
LEAST_SCORE = 0.25
# Characters worked on at a time, and distinct trigrams a task holds before it emits them.
CHUNK = 1 << 19
HELD = 1 << 20

_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool))
    return _LETTERS[0]


def trigrams(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (text number of each trigram, trigram as three 21-bit code points).

    Long texts come in several parts, whose ends see their true neighbours.
    """
    units, owners, held = [], [], 0
    for number, text in enumerate(texts):
        if not text:
            continue
        low = text.lower()
        for a in range(0, len(low), CHUNK):
            body = low[a:a + CHUNK]
            units.append((low[a - 1] if a else "\n") + body + (low[a + CHUNK:a + CHUNK + 1] or "\n"))
            owners.append(number)
            held += len(body)
            if held >= CHUNK:
                yield _grams(units, owners)
                units, owners, held = [], [], 0
    if units:
        yield _grams(units, owners)


def _grams(units: list[str], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    letter = _is_letter()[codes]
    codes[~letter] = 32
    ends = np.cumsum(sizes)
    letter[ends - 1] = False
    letter[ends - sizes] = False
    at = np.flatnonzero(letter)
    grams = (codes[at - 1] << 42) | (codes[at] << 21) | codes[at + 1]
    return np.repeat(np.asarray(owners), sizes)[at], grams


def _positions(grams: np.ndarray) -> Iterator[np.ndarray]:
    """The slots of each trigram: double hashing of a multiplicative mix."""
    with np.errstate(over="ignore"):
        x = grams.astype(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        mask = np.uint64((1 << SLOTS_LOG2) - 1)
        step = (x >> np.uint64(40)) | np.uint64(1)
        for i in range(HASHES):
            yield ((x + np.uint64(i) * step) & mask).astype(np.int64)


@dataclass(frozen=True)
class LanguageFilters:
    """Learnt filters: slots x words of 64 languages each, and false-positive rates."""

    languages: tuple[str, ...]
    slots: np.ndarray
    false_positive: np.ndarray

    @classmethod
    def of(cls, known: dict[str, np.ndarray]) -> LanguageFilters:
        """From each language's trigrams."""
        languages = tuple(sorted(known))
        slots = np.zeros((1 << SLOTS_LOG2, max(1, -(-len(languages) // 64))), np.uint64)
        rates = []
        for i, name in enumerate(languages):
            word, bit = i // 64, np.uint64(1 << (i % 64))
            for at in _positions(known[name]):
                slots[at, word] |= bit
            rates.append(float(np.mean((slots[:, word] & bit) != 0)) ** HASHES)
        return cls(languages, slots, np.asarray(rates))

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """For each trigram the bitmask of all languages that contain it."""
        masks = None
        for at in _positions(grams):
            masks = self.slots[at] if masks is None else masks & self.slots[at]
        return masks

    def scores(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each text's trigrams per language, and their number."""
        texts = list(texts)
        total = np.zeros(len(texts), np.int64)
        hits = np.zeros((len(texts), len(self.languages)), np.int64)
        for owner, grams in trigrams(texts):
            if not len(owner):
                continue
            masks = self.containing(grams)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            who = owner[starts]
            total[who] += np.diff(np.r_[starts, len(owner)])
            for i in range(len(self.languages)):
                bits = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                hits[who, i] += np.add.reduceat(bits.astype(np.int64), starts)
        share = hits / np.maximum(total, 1)[:, None]
        return np.clip((share - self.false_positive) / (1 - self.false_positive), 0.0, 1.0), total

    def classify(self, texts: Iterable[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of every text."""
        score, total = self.scores(texts)
        if not self.languages:
            return [UND] * len(total), np.zeros(len(total))
        best = score.argmax(axis=1)
        return ([self.languages[b] if n else UND for b, n in zip(best, total)],
                np.where(total > 0, score[np.arange(len(total)), best], 0.0))


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_rate: float = MIN_RATE
) -> LanguageFilters:
    """Filters from all rows whose text and language are not null.

    Every task counts its trigrams per language; the counts are summed in one
    shuffle. What reaches the driver is at most ``1 / min_rate`` trigrams per
    language.
    """
    ready_for_python(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def emit():
            return pd.concat([pd.DataFrame({"lang": k, "gram": g, "n": n})
                              for k, (g, n) in held.items()])

        for batch in batches:
            for name, part in batch.groupby("lang", sort=False)["text"]:
                for _, grams in trigrams(part):
                    one = np.unique(grams, return_counts=True)
                    held[name] = _merged(held[name], one) if name in held else one
            if sum(len(g) for g, _ in held.values()) > HELD:
                yield emit()
                held.clear()
        if held:
            yield emit()

    rows = docs.select(quoted(lang).alias("lang"), quoted(text).alias("text")).dropna()
    counts = (rows.mapInPandas(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = materialize(counts)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").filter(F.col("n") >= min_rate * F.col("total"))
    table = kept.select("lang", "gram").toPandas()
    return LanguageFilters.of({k: g.to_numpy(np.int64) for k, g in table.groupby("lang")["gram"]})


def _merged(a, b):
    grams, where = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([a[1], b[1]])).astype(np.int64)


def predictor(spark: SparkSession, filters: LanguageFilters):
    """A column function text -> struct(lang, score) that uses the filters on the executors."""
    ready_for_python(spark)
    shared = spark.sparkContext.broadcast(filters)  # fixed slots, a word per 64 languages

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.classify(texts)
        return pd.DataFrame({"lang": lang, "score": score})

    return predict


def reach(score: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """What share a text of so many letters may well have: four standard errors above the one seen."""
    return score + 4 * np.sqrt(score * (1 - score) / np.maximum(letters, 1))


def floors(docs: DataFrame, filters: LanguageFilters, text: str = "text", lang: str = "lang") -> dict[str, float]:
    """Per language, the ``reach`` below which a text is in none of the learnt languages.

    From labelled rows. Those whose best score is a language's are its own, and
    show how low its texts come: the lowest thousandth. All whose best score and
    label are another's show what a foreign text gets from its filter: the
    highest hundredth. The floor is halfway between the two, and at least half as
    far below the former as that is below the median. A language without rows of
    its own gets ``LEAST_SCORE``, which no floor goes below. Reaches are counted
    in thousandths: a few thousand rows a language are what the driver sees.
    """
    ready_for_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = shared.value.languages
        for batch in batches:
            score, letters = shared.value.scores(batch["text"])
            at = np.floor(1000 * reach(score, letters[:, None])).astype(np.int64)
            best = score.argmax(axis=1) if names else letters
            for i, name in enumerate(names):
                own = best == i
                used = (letters > 0) & (own | (batch["lang"] != name).to_numpy())
                part = pd.DataFrame({"own": own[used], "at": at[used, i]}).value_counts().reset_index(name="n")
                yield part.assign(lang=name)[["lang", "own", "at", "n"]]

    rows = docs.select(quoted(lang).alias("lang"), quoted(text).alias("text")).dropna()
    found = rows.mapInPandas(count, "lang string, own boolean, at long, n long").groupBy("lang", "own", "at").agg(
        F.sum("n").alias("n")).toPandas().sort_values("at")
    out = {}
    for name in filters.languages:
        of = {own: part for own, part in found[found["lang"] == name].groupby("own")}
        if True not in of:
            out[name] = LEAST_SCORE
            continue
        lowest, median = _quantile(of[True], 0.001), _quantile(of[True], 0.5)
        floor = lowest - (median - lowest) / 2
        if False in of:
            floor = min(floor, (lowest + _quantile(of[False], 0.99)) / 2)
        out[name] = max(LEAST_SCORE, float(floor) / 1000)
    return out


def _quantile(counted: pd.DataFrame, share: float) -> int:
    """The value below or at which that share of the rows lies."""
    total = counted["n"].cumsum().to_numpy()
    return int(counted["at"].to_numpy()[np.searchsorted(total, share * total[-1])])


def recognizer(spark: SparkSession, filters: LanguageFilters, least: dict[str, float]):
    """A column function text -> whether the text reaches the floor of its most likely language."""
    ready_for_python(spark)
    shared = spark.sparkContext.broadcast((filters, np.array([least[n] for n in filters.languages])))

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        filters, least = shared.value
        score, letters = filters.scores(texts)
        if not filters.languages:
            return pd.Series(np.zeros(len(letters), bool))
        best = score.argmax(axis=1)
        top = score[np.arange(len(best)), best]
        return pd.Series((letters > 0) & (reach(top, letters) >= least[best]))

    return known


def held_out(doc_id: str | Column) -> Column:
    """A quarter of the documents, by checksum of the id, is never learnt from."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % 4 == 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = learn(docs.filter(~held_out("doc_id")))
    found = docs.select("doc_id", predictor(spark, filters)("text").alias("p"))
    return found.select("doc_id", held_out("doc_id").alias("held_out"),
                        F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
