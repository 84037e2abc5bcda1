"""Substring duplicates removed by suffix automata of reference passages.

A window is ``WINDOW`` consecutive words of a document. Words covered by a window
whose words also start earlier, in a document with a smaller id or before in the
same one, are removed; windows are judged on the input.

What may repeat: every window has an anchor, its run of ``ANCHOR`` words with the
smallest hash, so equal windows have equal anchors. Windows whose anchor occurs
once in the corpus are unique and go no further.

Reference shards: the first document that holds an anchor is the reference of all
windows with that anchor, and its passages made of such windows are one shard.
A window that occurs in that document at all occurs there first. Tasks build the
suffix automaton of a shard and stream all passages that refer to it: where the
matching statistics reach ``WINDOW`` the window is found, and found windows merge
into maximal spans to remove. The reference itself is streamed too, against the
first position of each match. Windows that are not found do not occur in their
reference; they refer, in a second round of the same steps, to the first document
that has the whole window, with the window's hash in the anchor's place. Hashes
only tell where to look: what is removed was matched word by word.

Scale: tables are joined and grouped by anchor or by document, counts and minima
are taken in the map tasks first. A shard is a document's passages, whatever the
corpus; if very many passages refer to one, they are dealt to several tasks,
``STREAMED`` of an anchor to each, with an automaton of their own, in place of
one broadcast that no size bounds. Nothing is gathered on the driver.

Defined results: null text is empty; a null id counts as the largest; rows that
share an id are documents of their own, in the order of the input. Texts shorter
than a window stay whole. Repeated rows lose all words but in the first of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.phrases import _extended, _hashes, _words
from plantloom.llm.tables import quoted, read, ready_for_python, text_of
from plantloom.session import materialize, scratch_folder

WINDOW = 20
ANCHOR = 6
# Occurrences of an anchor that one task streams.
STREAMED = 4096
# Bytes of text worked on at a time.
BLOCK = 1 << 22
LAST = (1 << 63) - 1
# The separators as spaces.
PLAIN = bytes(32 if 9 <= c <= 13 else c for c in range(256))
PASSAGE = "d long, r long, start long, text binary"


# ---- suffix automaton --------------------------------------------------------------------------

class SuffixAutomaton:
    """All runs of words of some passages, each with the first place it ends at."""

    def __init__(self) -> None:
        self.following: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [-1]

    def add(self, words: list[bytes], start: int) -> None:
        """A passage whose first word is number ``start`` of its document; passages come in order."""
        following, link, length, ends = self.following, self.link, self.length, self.ends
        last = 0
        for place, word in enumerate(words, start):
            after = following[last].get(word)
            if after is not None and length[after] == length[last] + 1:
                last = after
                continue
            if after is not None:
                last = self._split(last, word, after)
                continue
            new = len(link)
            following.append({})
            length.append(length[last] + 1)
            ends.append(place)
            link.append(0)
            at, last = last, new
            while at >= 0 and word not in following[at]:
                following[at][word] = new
                at = link[at]
            if at >= 0:
                after = following[at][word]
                link[new] = after if length[after] == length[at] + 1 else self._split(at, word, after)

    def _split(self, at: int, word: bytes, after: int) -> int:
        """The state for the shorter runs of ``after``, which now end elsewhere too."""
        following, link, length = self.following, self.link, self.length
        short = len(link)
        following.append(following[after].copy())
        length.append(length[at] + 1)
        self.ends.append(self.ends[after])
        link.append(link[after])
        link[after] = short
        while at >= 0 and following[at].get(word) == after:
            following[at][word] = short
            at = link[at]
        return short

    def first_ends(self, words: list[bytes], window: int) -> Iterator[tuple[int, int]]:
        """(number of a word, first end of the window that ends there), where one matches."""
        following, link, length, ends = self.following, self.link, self.length, self.ends
        at, matched = 0, 0
        for place, word in enumerate(words):
            while at and word not in following[at]:
                at = link[at]
                matched = length[at]
            after = following[at].get(word)
            if after is None:
                continue
            at, matched = after, matched + 1
            if matched >= window:
                # the state of the window itself
                while length[link[at]] >= window:
                    at = link[at]
                matched = min(matched, length[at])
                yield place, ends[at]


# ---- anchors and passages ----------------------------------------------------------------------

def _windows(texts: list[bytes], anchor: int, window: int):
    """Words' byte ranges, texts they are in, valid windows, and each window's anchor and its place."""
    data = b"".join(t.translate(PLAIN) + b"\n" for t in texts)
    known, word, owner = _words(data)
    hashes = _hashes(known.to_pylist())[word] if len(word) else np.empty(0, np.uint64)
    count = len(word) - window + 1
    if count < 1:
        return data, owner, np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    run = hashes[:len(hashes) - anchor + 1].copy()
    for j in range(1, anchor):
        run = _extended(run, hashes[j:len(hashes) - anchor + 1 + j])
    # the smallest hash from each word on, over ever longer stretches, and the first place that has it
    span, smallest, reach = window - anchor + 1, run, 1
    while reach < span:
        more = min(reach, span - reach)
        smallest, reach = np.minimum(smallest[:-more], smallest[more:]), reach + more
    starts = np.flatnonzero(owner[:count] == owner[window - 1:])
    smallest, places = smallest[starts], np.empty(len(starts), np.int64)
    for j in reversed(range(span)):
        there = run[starts + j] == smallest
        places[there] = starts[there] + j
    return data, owner, starts, smallest, places


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices whose texts come to some ``BLOCK`` bytes, or hold one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + BLOCK, "right")))
            yield batch.slice(at, to - at)
            at = to


def _anchors(texts: DataFrame, anchor: int, window: int) -> DataFrame:
    """(anchor, d, r, start, n): the anchors of each text and how many places they have there."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "text"):
            _, owner, _, found, places = _windows(batch.column("text").to_pylist(), anchor, window)
            places, first = np.unique(places, return_index=True)
            found, owner = found[first].view(np.int64), owner[places]
            order = np.lexsort((found, owner))
            found, owner = found[order], owner[order]
            new = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])][:len(found)])
            row = pa.array(owner[new])
            yield pa.RecordBatch.from_arrays([
                pa.array(found[new]), *[batch.column(c).take(row) for c in ("d", "r", "start")],
                pa.array(np.diff(np.r_[new, len(found)]), pa.int64())], names=["anchor", "d", "r", "start", "n"])

    return texts.mapInArrow(find, "anchor long, d long, r long, start long, n long")


def _passages(texts: DataFrame, anchor: int, window: int, streamed: int) -> DataFrame:
    """Passages of windows that may repeat, with the document they refer to.

    ``target`` is that document, ``parts`` and ``part`` deal out what refers to it;
    ``streamed`` is false for the passages an automaton is made of.
    """
    found = materialize(_anchors(texts, anchor, window))
    repeated = found.groupBy("anchor").agg(
        F.sum("n").alias("total"), F.min(F.struct("d", "r")).alias("first")).filter("total > 1")
    hits = materialize(found.join(repeated, "anchor").groupBy("r", "start").agg(
        F.collect_list(F.struct("anchor", F.col("first.r").alias("target"), "total")).alias("hits")))
    drop_old_shuffles(texts.sparkSession)
    rows = texts.join(hits.withColumnsRenamed({"r": "_r", "start": "_start"}),
                      (F.col("r") == F.col("_r")) & (F.col("start") == F.col("_start"))).select(
        "d", "r", "start", "text", "hits.anchor", "hits.target", "hits.total")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "text"):
            data, owner, starts, anchors, _ = _windows(batch.column("text").to_pylist(), anchor, window)
            known, at = np.unique(batch.column("anchor").flatten().to_numpy(), return_index=True)
            target = batch.column("target").flatten().to_numpy()[at]
            total = batch.column("total").flatten().to_numpy()[at]
            parts = 1 << np.ceil(np.log2(np.maximum(total / streamed, 1))).astype(np.int64)
            anchors = anchors.view(np.int64)
            place = np.minimum(np.searchsorted(known, anchors), len(known) - 1)
            some = known[place] == anchors
            starts, place = starts[some], place[some]
            # runs of windows, one word apart, that refer to the same document in the same way
            new = np.r_[True, (np.diff(starts) != 1) | (owner[starts[1:]] != owner[starts[:-1]])
                        | (target[place[1:]] != target[place[:-1]])
                        | (parts[place[1:]] != parts[place[:-1]])][:len(starts)]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(starts)][:len(first)] - 1
            raw = np.frombuffer(data, np.uint8)
            ends = np.flatnonzero((raw == 32) | (raw == 10))
            ends = ends[np.diff(ends, prepend=-1) > 1]
            begins = np.searchsorted(owner, np.arange(batch.num_rows))
            ids = [batch.column(c).to_numpy() for c in ("d", "r", "start")]
            out: list[tuple] = []
            for a, b in zip(first.tolist(), last.tolist()):
                s, e, doc = starts[a], starts[b] + window, owner[starts[a]]
                text = data[(ends[s - 1] + 1 if s else 0):ends[e - 1]]
                d, r, start = int(ids[0][doc]), int(ids[1][doc]), int(ids[2][doc] + s - begins[doc])
                to, n = int(target[place[a]]), int(parts[place[a]])
                if r == to:
                    out += [(to, n, i, False, d, r, start, text) for i in range(n)]
                    out.append((to, n, 0, True, d, r, start, text))
                else:
                    out.append((to, n, (r ^ r >> 33) % n, True, d, r, start, text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 8, ROUTED_TYPES)], names=ROUTED_NAMES)

    return rows.mapInArrow(cut, ROUTED)


ROUTED = f"target long, parts long, part long, streamed boolean, {PASSAGE}"
ROUTED_NAMES = [c.split()[0] for c in ROUTED.split(", ")]
ROUTED_TYPES = [{"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]]
                for c in ROUTED.split(", ")]


def _matched(passages: DataFrame, window: int) -> DataFrame:
    """Spans (r, start, end) to remove, and passages of windows their reference does not hold.

    The latter have a ``text``. Passages of a reference come in one stretch of a
    task, those its automaton is made of first.
    """
    key = ["target", "parts", "part"]
    dealt = passages.repartition(*key).sortWithinPartitions(*key, "streamed", "r", "start")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, automaton = None, None
        for batch in batches:
            out: list[tuple] = []
            for to, n, i, streamed, d, r, start, text in zip(*[c.to_pylist() for c in batch.columns]):
                if (to, n, i) != current:
                    current, automaton = (to, n, i), SuffixAutomaton()
                words = text.split()
                if not streamed:
                    automaton.add(words, start)
                    continue
                found = np.zeros(len(words) - window + 1, bool)
                gone = np.zeros(len(found), bool)
                for place, end in automaton.first_ends(words, window):
                    found[place - window + 1] = True
                    gone[place - window + 1] = r != to or end < start + place
                for a, b in _runs(gone):
                    out.append((d, r, start + a, start + b + window - 1, None))
                for a, b in _runs(~found):
                    out.append((d, r, start + a, None, b" ".join(words[a:b + window - 1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5,
                                                [pa.int64()] * 4 + [pa.binary()])],
                names=["d", "r", "start", "end", "text"])

    return dealt.mapInArrow(match, "d long, r long, start long, end long, text binary")


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Ranges [a, b) of consecutive true flags."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


# ---- the operator ------------------------------------------------------------------------------

def numbered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, d, r, start, text): the documents with their place in the order, written once.

    ``row`` holds the columns beside the text.
    """
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns if c != text]).alias("row"),
                       F.coalesce(quoted(doc_id).cast("long"), F.lit(LAST)).alias("d"),
                       F.monotonically_increasing_id().alias("r"), F.lit(0).cast("long").alias("start"),
                       text_of(quoted(text)).cast("binary").alias("text"))
    folder = scratch_folder(docs.sparkSession)
    rows.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


def drop_old_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of plans that are done with.

    It does so for whatever the driver's garbage collection finds unused, which
    would otherwise come only when the driver is short of memory.
    """
    spark.sparkContext._jvm.System.gc()


def repeated_spans(rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   streamed: int = STREAMED) -> DataFrame:
    """(r, start, end): spans of words to remove from ``numbered`` rows; they may touch or overlap."""
    ready_for_python(rows.sparkSession)
    one = materialize(_matched(_passages(rows.select("d", "r", "start", "text"), anchor, window, streamed), window))
    drop_old_shuffles(rows.sparkSession)
    open_ = one.filter("text IS NOT NULL").select("d", "r", "start", "text")
    two = _matched(_passages(open_, window, window, streamed), window)
    found = one.filter("text IS NULL").union(two.filter("text IS NULL")).select("r", "start", "end")
    found = materialize(found)
    drop_old_shuffles(rows.sparkSession)
    return found


def without_repeats(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``numbered`` rows as (row, n_words, n_removed, kept): words kept, joined by one space."""
    per_row = spans.groupBy("r").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = rows.select("row", "r", "text").join(
        per_row.withColumnRenamed("r", "_r"), F.col("r") == F.col("_r"), "left").select(
        "row", "text", "spans.start", "spans.end")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, starts, ends in zip(*[c.to_pylist() for c in batch.columns[1:]]):
                words = text.translate(PLAIN).split()
                stay = np.ones(len(words), bool)
                for a, b in zip(starts or (), ends or ()):
                    stay[a:b] = False
                counts.append(len(words))
                removed.append(int(len(words) - stay.sum()))
                kept.append(b" ".join(w for w, s in zip(words, stay.tolist()) if s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary())], names=["row", "n_words", "n_removed", "kept"])

    row = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(remove, f"row {row}, n_words long, n_removed long, kept binary").withColumn(
        "kept", F.col("kept").cast("string"))


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, same columns, their text being the words that stay."""
    rows = numbered(docs, doc_id, text)
    found = without_repeats(rows, repeated_spans(rows))
    return found.select(*[F.col("kept").alias(c) if c == text else F.col("row").getField(c).alias(c)
                          for c in docs.columns])


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the passages that occur before."""
    rows = numbered(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = without_repeats(rows, repeated_spans(rows))
    return found.select("row.doc_id", "n_words", "n_removed",
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
