"""Phrase collocations by dynamic itemset counting.

Phrases are runs of words within a piece of text, counted per language with
overlaps. The documents are dealt into ``SHARDS`` shards, which are scanned in
turn, over and over. Words are counted from the first step on. A longer phrase
becomes active once both phrases it consists of, all but its last word and all
but its first, have been seen often enough so far; lengths are thus counted side
by side. An active phrase is counted until it has met every shard once, a full
cycle, and then stops. The scans end when a whole cycle activated nothing.

A step scans one shard. Its tasks hold a text block's words as numbers, find the
active phrases of all lengths and write a count per distinct phrase and block,
with the step in which the phrase became active. When that step's phrases have
met all shards their counts are added up, in one shuffle, and are exact; in
between, large counts alone are added up, a small part of all, which shows most
frequent phrases long before their cycle ends.

What is often enough reaches the tasks as a Bloom filter of a byte a slot, the
first step that set it, so one look tells since when a phrase passes. It has
``SLOTS`` slots, or fewer for little text. False positives make phrases active
early, no more: whether and since when is the same in all tasks and later steps.
In a corpus whose frequent phrases outgrow the slots ever more pass, and the
cost tends to that of counting every phrase; counts stay exact.

Scores: for a phrase of count a and each cut, with counts l and r of the parts,
floor(2000000 a / (l + r)); the lowest counts, the first of equal ones. Phrases
within a longer frequent one, dropped or not, that occurs at least 0.8 times as
often, are dropped.

Defined results: null text is empty; null language is ``und``, together with
documents whose language says so. Empty tables and languages without frequent
phrases have no rows. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantloom.llm.tables import quoted, read, ready_for_python, text_of
from plantloom.session import materialize, remove, scratch_folder

UND = "und"
LEAST = 30
LONGEST = 4
PER_LANG = 2000
SHARDS = 3
SLOTS = 1 << 24
# Counts of a block that are added up before their cycle ends.
LARGE = 5
HASHES = 4
# In a slot: set in no step.
NEVER = 255
# Bytes of text worked on at a time, and held over all languages.
BLOCK, HELD = 1 << 23, 1 << 25
SPACE, BREAK = 32, 10
# A-Z in lower case, tab as space, what ends a piece as line feed.
PLAIN = bytes(BREAK if chr(c) in ".,;:!?\n\x0b\x0c\r" else SPACE if c == 9 else c + 32 if 65 <= c <= 90 else c
              for c in range(256))
COUNTS = "lang string, k int, phrase binary, n long, since int, large boolean"
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ---- which phrases have been seen often enough -------------------------------------------------

def _hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _extended(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase (or of a language) with one more word."""
    with np.errstate(over="ignore"):
        x = (phrase ^ (phrase >> np.uint64(29))) * _MIX + word
        return x ^ (x >> np.uint64(32))


def _places(hashes: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        x = hashes * _MIX
        step = (x >> np.uint64(33)) | np.uint64(1)
        for i in range(HASHES):
            yield ((x + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64)


def since(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The first step whose filter passes each phrase; ``NEVER`` if none does."""
    return np.maximum.reduce([filled[at] for at in _places(hashes, len(filled))])


def _set_slots(reached: DataFrame, slots: int) -> np.ndarray:
    """Which slots the phrases set; put together in a shuffle, 64 of them to a row."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(slots, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            words = pc.split_pattern(batch.column("phrase"), b" ")
            coded = words.flatten().dictionary_encode()
            known = _hashes(coded.dictionary.to_pylist())
            codes, lengths = coded.indices.to_numpy(), words.value_lengths().to_numpy()
            starts = np.cumsum(lengths) - lengths
            langs = batch.column("lang").dictionary_encode()
            found = _hashes([x.encode() for x in langs.dictionary.to_pylist()])[langs.indices.to_numpy()]
            for j in range(int(lengths.max())):
                longer = lengths > j
                found[longer] = _extended(found[longer], known[codes[starts[longer] + j]])
            for at in _places(found, slots):
                held[at] = True
        packed = np.packbits(held, bitorder="little").view(np.int64)
        used = np.flatnonzero(packed)
        yield pa.RecordBatch.from_pydict({"i": used, "w": packed[used]})

    rows = reached.select("lang", "phrase").mapInArrow(place, "i long, w long").groupBy("i").agg(
        F.bit_or("w").alias("w")).toPandas()
    packed = np.zeros(slots >> 6, np.int64)
    packed[rows["i"].to_numpy(np.int64)] = rows["w"].to_numpy(np.int64)
    return np.unpackbits(packed.view(np.uint8), bitorder="little").astype(bool)


# ---- counting a block of text ------------------------------------------------------------------

def _words(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word in order, and the piece each is in."""
    raw = np.frombuffer(data, np.uint8)
    breaks = raw == BREAK
    ends = np.flatnonzero(breaks | (raw == SPACE))
    after_break = breaks[ends]
    piece = np.cumsum(after_break) - after_break
    some = np.diff(ends, prepend=-1) > 1
    # every word with the separator behind it, so that words lie end to end
    text = pa.py_buffer(data.replace(b"\n", b" "))
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends + 1
    words = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), text])
    coded = words.filter(pa.array(some)).dictionary_encode()
    return (pc.binary_slice(coded.dictionary, 0, -1), coded.indices.to_numpy().astype(np.int64),
            piece[some])


def count_block(data: bytes, lang: str, filled: np.ndarray, step: int, shards: int,
                longest: int) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(length, phrases, counts, active since) of what a step counts in a block of plain text."""
    known, word, piece = _words(data)
    if not len(word):
        return
    by_word = _hashes(known.to_pylist())
    hashes = _extended(np.full(len(by_word), xxhash.xxh64_intdigest(lang.encode()), np.uint64), by_word)
    if step < shards:
        yield 1, known, np.bincount(word, minlength=len(known)), np.zeros(len(known), np.uint8)
    # since when each distinct phrase of the length before is known to be frequent
    often = since(filled, hashes)
    phrase, spelled = word, [np.arange(len(known))]  # number at each place, words of each number
    for k in range(2, longest + 1):
        left, right = phrase[:-1], phrase[1:]
        there = np.flatnonzero(piece[:-1] == piece[1:] if k == 2 else (left >= 0) & (right >= 0))
        there = there[np.maximum(often[left[there]], often[right[there]]) <= step]
        if not len(there):
            return
        size = len(spelled[0])
        number, pairs = pd.factorize(left[there] * size + right[there])
        first, last = pairs // size, pairs % size
        spelled = [s[first] for s in spelled] + [spelled[-1][last]]
        active = np.maximum(often[first], often[last])
        wanted = np.flatnonzero(active.astype(int) > step - shards)
        if len(wanted):
            parts = [known.take(pa.array(s[wanted])) for s in spelled]
            yield (k, pc.binary_join_element_wise(*parts, b" "),
                   np.bincount(number, minlength=len(pairs))[wanted], active[wanted])
        hashes = _extended(hashes[first], by_word[spelled[-1]])
        often = np.maximum(active, since(filled, hashes))
        longer = np.full(len(phrase) - 1, -1)
        longer[there] = number
        phrase = longer


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(language, plain text) in blocks; documents end in a break, long ones are cut at breaks."""
    held: dict[str, list[bytes]] = defaultdict(list)
    sizes: dict[str, int] = defaultdict(int)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text.translate(PLAIN) + b"\n"
            while len(text) > 2 * BLOCK:
                cut = text.find(b"\n", BLOCK) + 1
                yield lang, text[:cut]
                text = text[cut:]
            held[lang].append(text)
            sizes[lang] += len(text)
            if sizes[lang] > BLOCK or sum(sizes.values()) > HELD:
                largest = max(sizes, key=sizes.get)
                yield largest, b"".join(held.pop(largest))
                del sizes[largest]
    for lang, texts in held.items():
        yield lang, b"".join(texts)


# ---- the scans ---------------------------------------------------------------------------------

def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    shards: int = SHARDS,
    slots: int = SLOTS,
) -> tuple[DataFrame, DataFrame]:
    """Phrases (lang, k, phrase, n) of up to ``longest`` words seen ``least`` times; words per lang.

    Intermediate tables lie in shared storage: the shards and the counts of each
    step, of which there are ``longest * shards`` at most, which are removed in
    the end, and the exact sums.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    folder = scratch_folder(spark)
    docs.select(F.coalesce(quoted(lang), F.lit(UND)).alias("lang"),
                text_of(quoted(text)).cast("binary").alias("text"),
                (F.monotonically_increasing_id() % shards).alias("shard")).write.partitionBy(
        "shard").option("compression", "zstd").parquet(f"{folder}/shards")
    schema = "lang string, text binary, shard long"
    dealt = spark.read.schema(schema).parquet(f"{folder}/shards")
    # a slot for every 16 bytes of text, as far as there are so many
    size = dealt.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    slots = min(slots, max(64, 1 << (size // 16).bit_length()))
    filled, changed, step, sums = np.full(slots, NEVER, np.uint8), 0, 0, []
    while step < changed + shards:
        shared = spark.sparkContext.broadcast(filled)  # ``slots`` bytes

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for name, data in _blocks(batches):
                for k, phrases, n, active in count_block(data, name, shared.value, step, shards, longest):
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([name] * len(n), pa.string()), "k": pa.array(np.full(len(n), k, np.int32)),
                        "phrase": phrases, "n": pa.array(n, pa.int64()),
                        "since": pa.array(active.astype(np.int32)), "large": pa.array(n >= LARGE)})

        dealt.filter(F.col("shard") == step % shards).select("lang", "text").mapInArrow(
            count, COUNTS).write.partitionBy("since", "large").parquet(f"{folder}/counts/step={step}")
        shared.unpersist()
        step += 1
        counts = spark.read.schema(f"{COUNTS}, step int").parquet(f"{folder}/counts")
        reached = counts.filter(F.col("large") & (F.col("since") > step - shards) & (F.col("k") < longest))
        reached = _frequent(reached, least).select("lang", "phrase")
        if step >= shards:
            # all shards have met the phrases active since then
            sums.append(materialize(_frequent(counts.filter(F.col("since") == step - shards), least)))
            reached = reached.union(sums[-1].filter(F.col("k") < longest).select("lang", "phrase"))
        fresh = _set_slots(reached, slots)
        fresh &= filled == NEVER
        if fresh.any():
            filled[fresh], changed = step, step
    words = materialize(spark.read.schema(f"{COUNTS}, step int").parquet(f"{folder}/counts").filter(
        "k = 1").groupBy("lang").agg(F.sum("n").alias("n")))
    often = reduce(DataFrame.union, sums).select("lang", "k", F.col("phrase").cast("string").alias("phrase"), "n")
    remove(spark, folder)
    return often, words


def _frequent(counts: DataFrame, least: int) -> DataFrame:
    return counts.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# ---- scores ------------------------------------------------------------------------------------

def _part(first: int | str, size: int | str) -> str:
    return f"array_join(slice(words, {first}, {size}), ' ')"


def collocations(often: DataFrame, words: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The best ``per_lang`` phrases of each language, ranked."""
    spelled = often.withColumn("words", F.split("phrase", " "))
    longer = spelled.filter("k >= 2")
    # the counts of both parts of every cut, then the lowest score
    cuts = longer.select("lang", "phrase", F.col("n").alias("a"), F.expr(
        f"explode(transform(sequence(1, k - 1), i -> struct(i, {_part(1, 'i')} AS one, {_part('i + 1', 'k - i')} AS two)))").alias("c")).select(
        "lang", "phrase", "a", F.col("c.i").alias("i"), "c.one", "c.two")
    left = often.select("lang", F.col("phrase").alias("one"), F.col("n").alias("l"))
    right = often.select("lang", F.col("phrase").alias("two"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "one"]).join(right, ["lang", "two"]).withColumn(
        "score", F.expr("(CAST(2000000 AS DECIMAL(20, 0)) * a) DIV (CAST(l AS DECIMAL(20, 0)) + r)"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "i", "l", "r")).alias("b"))
    # the most frequent longer phrase around each
    inner = spelled.filter("k >= 3").select("lang", "n", F.expr(
        f"explode(flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> {_part('i', 's')}))))").alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = best.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.expr("CAST(100 AS DECIMAL(20, 0)) * longer < CAST(80 AS DECIMAL(20, 0)) * a")))
    order = [F.col("b.score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within parts of a language, so that no task ranks all of one
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    leading = kept.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("rank") <= per_lang)
    ranked = leading.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= per_lang)
    # a row per language
    return ranked.join(F.broadcast(words), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("b.l").alias("l"),
        F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return collocations(*frequent_phrases(read(spark, sf_dir, "documents")))


OP11_SQL = r"""
WITH pieces AS (
    SELECT lang, doc, piece_no, regexp_extract_all(piece, '[^ \t]+') AS w FROM (
        SELECT lang, doc, UNNEST(p) AS piece, generate_subscripts(p, 1) AS piece_no FROM (
            SELECT COALESCE(lang, 'und') AS lang, ROW_NUMBER() OVER () AS doc,
                   regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
            FROM documents))),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, UNNEST(generate_series(1, LEN(w) - k + 1)) AS i
          FROM pieces, (SELECT UNNEST([1, 2, 3, 4]) AS k))),
f AS (SELECT lang, k, phrase, COUNT(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(SUM(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE n >= 30),
cuts AS (
    SELECT lang, phrase, n AS a, i, array_to_string(w[1:i], ' ') AS one,
           array_to_string(w[i + 1:k], ' ') AS two
    FROM (SELECT *, UNNEST(generate_series(1, k - 1)) AS i FROM often WHERE k >= 2)),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.i, x.n AS l, y.n AS r,
           (CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.n AS HUGEINT) + y.n) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.one
                JOIN f y ON y.lang = c.lang AND y.phrase = c.two),
best AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (
             PARTITION BY lang, phrase ORDER BY score, i) = 1),
around AS (
    SELECT lang, phrase, MAX(n) AS longer FROM (
        SELECT lang, n, array_to_string(w[i:i + s - 1], ' ') AS phrase
        FROM (SELECT *, UNNEST(generate_series(1, k - s + 1)) AS i
              FROM (SELECT *, UNNEST(generate_series(2, k - 1)) AS s FROM often WHERE k >= 3)))
    GROUP BY ALL),
kept AS (
    SELECT b.* FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase
    WHERE o.longer IS NULL OR CAST(100 AS HUGEINT) * o.longer < CAST(80 AS HUGEINT) * b.a)
SELECT k.lang, ROW_NUMBER() OVER (
           PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, t.n, CAST(score AS BIGINT) AS score
FROM kept k JOIN total t ON t.lang = k.lang
QUALIFY rank <= 2000
"""
