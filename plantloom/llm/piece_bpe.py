"""Merge-type subword encoding by backtracking over longest matches, and decoding.

Merging joins, again and again, the neighbours whose concatenation is the best
piece (highest score, leftmost on ties). Two facts replace the merging of whole
texts. A sequence of pieces is a text's encoding exactly if each neighbouring
pair, joined and merged again on its own, comes out as that pair. And every
prefix of a text has one encoding, so a position that cannot be continued never
needs to be reached twice. Encoding therefore walks from left to right: the
longest piece at a position that is compatible with the one before it, else its
next shorter prefix, else a step back, with a bitfield of the positions that
failed. One Aho-Corasick pass gives the longest pieces at all positions.

No piece joins a character to a following space mark, so texts are cut before
runs of marks and each distinct part is encoded once per worker while it stays
among the recently used. Characters outside the vocabulary become byte pieces.

Defined results: null counts as empty; an empty text has no pieces but the end
id if asked for. Any other text, however long and whatever characters, is whole.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Sequence

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.tables import read, ready_for_python, text_of

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_SURFACE = " ⁇ "  # fixed value: how an unknown piece decodes
# Parts remembered per worker, and half as many pairs (twice that at most); longer parts are not
# kept. Fewer cost time and spare memory, the outcome is the same.
REMEMBERED = 1 << 18
PART_LIMIT = 64


class Recent(dict):
    """A memory of bounded size: the older half goes when the newer half is full."""

    def __init__(self, make, most, key_limit=None, own=None):
        super().__init__()
        self.make, self.most, self.key_limit, self.older = make, most, key_limit, {}
        self.own = own  # an equal key that takes less room

    def __missing__(self, key):
        if self.key_limit and len(key) > self.key_limit:
            return self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[self.own(key) if self.own else key] = value
        return value


class PieceModel:
    """Vocabulary of a merge-type model with byte fallback and no text normalisation."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        source = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(source.get_piece_size())
        self.end_id = source.eos_id()
        pieces = [source.id_to_piece(i) for i in ids]
        special = {i for i in ids
                   if source.is_control(i) or source.is_unknown(i) or source.is_byte(i)}
        if any(source.is_unused(i) for i in ids) or not any(source.is_byte(i) for i in ids):
            raise ValueError("the model needs byte pieces and no unused ones")
        self.id_of = {p: i for i, p in enumerate(pieces) if i not in special}
        self.score = {p: source.get_score(i) for p, i in self.id_of.items()}
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("a piece spans a word boundary")
        byte_ids = {int(pieces[i][3:5], 16): i for i in ids if source.is_byte(i)}
        self.byte_id = [byte_ids[b] for b in range(256)]
        # what each id adds to a decoded text
        self.surface = [b"" if source.is_control(i)
                        else UNKNOWN_SURFACE.encode() if source.is_unknown(i)
                        else bytes([int(pieces[i][3:5], 16)]) if source.is_byte(i)
                        else pieces[i].replace(MARK, " ").encode() for i in ids]
        self.is_byte = np.array([source.is_byte(i) for i in ids])
        self.spaced = np.array([i not in special and pieces[i].startswith(MARK) for i in ids])
        self.adds = np.array([not source.is_control(i) for i in ids])
        self.words = ahocorasick.Automaton()
        for p in self.id_of:
            self.words.add_word(p, len(p) - 1)
        self.words.make_automaton()
        # the longest piece that is a proper prefix of a piece
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id_of),
                                None) for p in self.id_of}
        self.part = re.compile(self._parts())
        # pairs are kept with the vocabulary's strings, not with slices of texts
        own = {p: p for p in self.id_of}
        self.compatible = Recent(lambda pair: self.merged(pair[0] + pair[1]) == list(pair),
                                 remembered // 2,
                                 own=lambda pair: (own.get(pair[0], pair[0]), own.get(pair[1], pair[1])))
        self.stable = Recent(lambda piece: self.merged(piece) == [piece], remembered // 2)
        self.part_ids = Recent(self.encode_part, remembered, PART_LIMIT)

    def _parts(self) -> str:
        """A pattern that cuts texts where no piece reaches across.

        Such places are before space marks, around line ends, and before those
        other marks that no piece has after any character but another such mark.
        """
        before: dict[str, set[str]] = {}
        for p in self.id_of:
            for a, b in zip(p, p[1:]):
                before.setdefault(b, set()).add(a)
        apart = {c for p in self.id_of for c in p if not c.isalpha() and c != MARK}
        while wrong := {c for c in apart if before.get(c, set()) - apart - {MARK}}:
            apart -= wrong
        starts = apart & set(string.punctuation)  # few characters keep the pattern fast
        while more := {a for c in starts for a in before.get(c, set())} - starts - {MARK}:
            starts |= more
        line = "\n" if not any("\n" in p for p in self.id_of) else ""
        first = re.escape("".join(sorted(starts)))
        rest = f"[^ {MARK}{line}{first}]"
        marks = f"[ {MARK}]"
        choices = [f"{marks}*[{first}]+{rest}*"] if starts else []
        choices += [f"{marks}*{rest}+", f"{marks}+"] + (["\n"] if line else [])
        return "|".join(choices)

    def merged(self, text: str) -> list[str]:
        """Plain merging, used on single pieces and on pairs only."""
        parts, score, never = list(text), self.score.get, float("-inf")
        gains = [score(a + b, never) for a, b in zip(parts, parts[1:])]
        while gains and (best := max(gains)) > never:
            i = gains.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del gains[i]
            if i:
                gains[i - 1] = score(parts[i - 1] + parts[i], never)
            if i < len(gains):
                gains[i] = score(parts[i] + parts[i + 1], never)
        return parts

    def split(self, part: str) -> list[str]:
        """The pieces of a part; characters outside the vocabulary stand alone."""
        # matches come by their ends, so the longest of a start is the last
        longest = {last - more: more + 1 for last, more in self.words.iter(part)}
        end, at, out = len(part), 0, []
        failed = bytearray(end + 1)
        compatible, shorter, size_at = self.compatible, self.shorter, longest.get
        piece = part[:size_at(0, 1)]
        while piece is not None and not self.stable[piece]:
            piece = shorter.get(piece)
        while True:
            if piece is not None:
                out.append(piece)
                at += len(piece)
                if at == end:
                    return out
                before, piece = piece, part[at:at + size_at(at, 1)]
            else:
                failed[at] = 1
                last = out.pop()
                at -= len(last)
                before, piece = out[-1] if out else None, shorter.get(last)
            while piece is not None and (failed[at + len(piece)] or not (
                    compatible[before, piece] if before else self.stable[piece])):
                piece = shorter.get(piece)

    def encode_part(self, part: str) -> bytes:
        """A part's ids as 32-bit integers; bytes for characters outside the vocabulary.

        A space in a part is a space mark: texts are cut as they are, since with
        marks in them each character of texts and remembered parts takes more room.
        """
        ids = array("i")
        for piece in self.split(part.replace(" ", MARK)):
            known = self.id_of.get(piece)
            if known is None:
                ids.extend(self.byte_id[b] for b in piece.encode())
            else:
                ids.append(known)
        return ids.tobytes()

    def encode(self, text: str | None, end: bool = True) -> np.ndarray:
        """All ids of a text."""
        tail = array("i", [self.end_id] if end else []).tobytes()
        parts = self.part.findall(" " + text) if text else []
        return np.frombuffer(b"".join(map(self.part_ids.__getitem__, parts)) + tail, np.intc)

    def decode(self, ids: Sequence[int] | None) -> str | None:
        """The text of ids, without the mark that encoding puts in front."""
        if ids is None:
            return None
        ids = np.asarray(ids, np.int64)
        surface = self.surface
        raw = b"".join([surface[i] for i in ids.tolist()])
        adding = np.flatnonzero(self.adds[ids])
        lead = len(adding) > 0 and self.spaced[ids[adding[0]]]
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        return text[1:] if lead else text

    def _decode_runs(self, ids: np.ndarray) -> str:
        """Runs of byte pieces that are not UTF-8: each stray byte is one replacement mark."""
        out, run = [], bytearray()
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            while run:
                size = 1 if run[0] < 0xC0 else 2 if run[0] < 0xE0 else 3 if run[0] < 0xF0 else 4
                try:
                    out.append(bytes(run[:size]).decode())
                except UnicodeDecodeError:
                    size = 1
                    out.append("�")
                del run[:size]
            if i is not None:
                out.append(self.surface[i].decode())
        return "".join(out)


_MODELS: dict[tuple[str, int], PieceModel] = {}


def model(path: str, remembered: int = REMEMBERED) -> PieceModel:
    """The model at a path, loaded once per process."""
    if (path, remembered) not in _MODELS:
        _MODELS[path, remembered] = PieceModel(path, remembered)
    return _MODELS[path, remembered]


def _file(path: str | None) -> str:
    return path or public_tokenizers.path(MODEL)


def encoder(spark: SparkSession, path: str | None = None, end: bool = True):
    """A column function text -> array of ids. The model file must be on every machine."""
    ready_for_python(spark)

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        pieces = model(_file(path))
        return pd.Series([pieces.encode(t, end) for t in texts])

    return encode


def decoder(spark: SparkSession, path: str | None = None):
    """A column function array of ids -> text."""
    ready_for_python(spark)

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        pieces = model(_file(path))
        return pd.Series([pieces.decode(x) for x in ids], dtype=object)

    return decode


def round_trip(spark: SparkSession, path: str | None = None, end: bool = True,
               remembered: int = REMEMBERED):
    """A column function text -> struct(ids, decoded): what it becomes, and what that becomes."""
    ready_for_python(spark)

    @F.pandas_udf("ids array<int>, decoded string")
    def code(texts: pd.Series) -> pd.DataFrame:
        pieces = model(_file(path), remembered)
        ids = [pieces.encode(t, end) for t in texts]
        return pd.DataFrame({"ids": ids, "decoded": [pieces.decode(x) for x in ids]})

    return code


def digests(docs: DataFrame, remembered: int = REMEMBERED) -> DataFrame:
    """Per document: number and digest of its ids, digest of what they decode to."""
    code = round_trip(docs.sparkSession, remembered=remembered)
    both = docs.select("doc_id", code(text_of("text")).alias("c")).select(
        "doc_id", "c.ids", "c.decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and their round trip."""
    return digests(read(spark, sf_dir, "documents"))
