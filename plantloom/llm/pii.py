"""Information-theoretic sanitisation of personal data.

Emails, addresses, card and phone numbers are protected entities. A term in a
document with an entity gives it away in so far as seeing the term tells the
entity. With n(t), n(e), n(e, t) documents of N holding the term, the entity,
and both, wherever they stand, P(e) = n(e) / N, and ``PRIOR`` documents that
follow P(e) added to those that hold t, the chance of the entity beside the term
and the disclosure, PMI(e; t) over the entity's information content, are

    chance = (n(e,t) + PRIOR P(e)) / (n(t) + PRIOR)
    disclosure = log(chance / P(e)) / log(N / n(e))

The disclosure nears 1 as the term is seen more often, and always with that
entity; it is less the more documents hold the term without it. Every pair is
scored, however rare. A term whose disclosure reaches ``GENERALISE`` is
generalised (to a class: number, name, word) at each of its places in the
documents that hold the entity. It is removed if the chance reaches ``REMOVE``
too: one document that holds both gives 2/3 at any size of the corpus and so
generalises only, from two on a term that is never without the entity goes. Of
several entities in a document the most disclosed decides. Documents that hold
none of them keep the term: there it stands beside nothing it gives away, though
at 0.9 there may be some. Words that are part of an entity are no terms;
entities themselves become their kind.
Equal texts count as one document in all of these numbers, and each is marked.

Entities that stand in the same documents have the same numbers with any term,
and so have terms with the same documents. Pairs are made of such classes: all
entities and terms that one document alone has are one pair, whatever their
number, and a document costs as many as its classes of either side multiply to.

Kinds: email, ip, card, phone, then term. Base kinds are leftmost and do not
overlap within a kind; a match failing its check is dropped, without retry.

Defined results: null and empty texts have no spans; an entity that is in every
document has nothing to disclose; repeated rows are rows of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm import spans as sp
from plantloom.llm.tables import quoted, read, ready_for_python, text_of
from plantloom.session import materialize

# Kinds in their order and their patterns.
BASE = ("email", "ip", "card", "phone")
TERM = "term"
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOT_DIGITS = re.compile(r"[^0-9]+")

PRIOR = 0.5
GENERALISE, REMOVE = 0.9, 0.75
# The Bloom filter has at least this many bits a term, within these powers of two (128 KB to 32 MB).
BLOOM_BITS, BLOOM_LOG2, BLOOM_SHIFTS = 16, (20, 28), (0, 18, 36)
REMEMBERED_WORDS = 1 << 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds one @: take the run before it, then match from it on."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    # a match starts where a run of digits does, so the look-behind only saves time
    for m in IP.finditer(text):
        parts = (p.lstrip(".").lstrip("0") for p in m.groups())
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = NOT_DIGITS.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
            yield m.span()


def find_entities(text: str | None) -> list[tuple[str, int, int]]:
    """Base spans by kind, then start."""
    if not text:
        return []
    finders = zip(BASE, (_emails, _ips, _cards, _phones))
    return [(kind, a, b) for kind, find in finders for a, b in find(text)]


def term_of(word: str) -> str:
    """A word without the marks around it, in lower case."""
    return word[slice(*_inner(word))].lower()


def distinct_words(text: str) -> set[str]:
    """What ``WORD`` finds, once each."""
    for space in "\t\n\v\f\r":
        text = text.replace(space, " ")
    words = set(text.split(" "))
    words.discard("")
    return words


def _inner(word: str) -> tuple[int, int]:
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return a, b


def find_terms(text: str, entities: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Terms of a text with their places, in order; words that touch an entity are none."""
    words = [m.span() for m in WORD.finditer(text)]
    ends = np.fromiter((b for _, b in words), np.int64, len(words))
    starts = np.fromiter((a for a, _ in words), np.int64, len(words))
    taken = np.zeros(len(words), bool)
    for _, a, b in entities:
        taken[int(np.searchsorted(ends, a, "right")):int(np.searchsorted(starts, b))] = True
    out = []
    for i in np.flatnonzero(~taken):
        at, word = words[i][0], text[slice(*words[i])]
        a, b = _inner(word)
        if a < b:
            out.append((word[a:b].lower(), at + a, at + b))
    return out


def _observed(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Per row the kept columns, the text's digest and base spans; written once.

    Rows with a span also have the text and the distinct entities.
    """
    ready_for_python(docs.sparkSession)

    @F.pandas_udf(f"base {sp.TYPE}, entities array<string>")
    def observe(texts: pd.Series) -> pd.DataFrame:
        found = [(t, find_entities(t)) for t in texts]
        return pd.DataFrame({"base": [sp.as_rows(e) for _, e in found],
                             "entities": [sorted({f"{k}:{t[a:b].lower()}" for k, a, b in e})
                                          for t, e in found]})

    rows = docs.select(F.struct(*[quoted(c) for c in keep]).alias("row"), _digest(text).alias("digest"),
                       quoted(text).alias("text"), observe(quoted(text)).alias("o"))
    return materialize(rows.select("row", "digest", "o.base", "o.entities", F.when(
        F.size("o.base") > 0, F.col("text")).alias("text")))


def _digest(text: str) -> Column:
    """Equal for copies; null counts as empty."""
    return F.unhex(F.md5(text_of(quoted(text)).cast("binary")))


def bloom_log2(terms: int) -> int:
    """The filter's bits, as a power of two."""
    least, most = BLOOM_LOG2
    return min(max((terms * BLOOM_BITS - 1).bit_length(), least), most)


def _term_documents(docs: DataFrame, text: str, terms: DataFrame, copies: DataFrame) -> DataFrame:
    """In how many distinct texts each of the given terms occurs anywhere.

    A Bloom filter sized by the number of terms, up to a bound, is shared with all
    tasks and keeps other words out of the shuffle; its false positives fall to
    the join with the terms.
    """
    size = bloom_log2(terms.count())
    mask = (1 << size) - 1
    hashed = F.xxhash64("term")
    bits = terms.select(F.explode(F.array(*[
        F.shiftrightunsigned(hashed, n).bitwiseAND(F.lit(mask)) for n in BLOOM_SHIFTS])).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toPandas()
    bloom = np.zeros(1 << (size - 6), "<i8")
    bloom[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bloom.tobytes())

    @F.pandas_udf("array<string>")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        filled = shared.value
        tried: dict[str, str | None] = {}  # words to their terms, none if not given

        def given(word: str) -> str | None:
            term = term_of(word)
            h = xxhash.xxh64_intdigest(term, 42)
            for n in BLOOM_SHIFTS:
                bit = h >> n & mask
                if not filled[bit >> 3] >> (bit & 7) & 1:
                    return None
            return term

        for texts in batches:
            out = []
            for t in texts:
                if len(tried) > REMEMBERED_WORDS:
                    tried.clear()
                words = distinct_words(t or "")
                for word in words.difference(tried):
                    tried[word] = given(word)
                found = set(map(tried.get, words))
                found.discard(None)
                out.append(list(found))
            yield pd.Series(out)

    # n copies weigh 1/n each, so that their sum rounds to a whole number
    rows = docs.select(known(quoted(text)).alias("terms"), _digest(text).alias("digest")).filter(
        F.size("terms") > 0).join(copies, "digest", "left")
    seen = rows.select(F.explode("terms").alias("term"), "n_copies").groupBy("term").agg(
        F.round(F.sum(1 / F.coalesce("n_copies", F.lit(1)))).alias("n_term"))
    return seen.join(terms, "term", "left_semi")


def _scores(total: int, n_entity: Column, n_pair: Column, n_term: Column) -> Column:
    """Struct (disclosure, chance), so that the largest is the most disclosed entity's."""
    share = n_entity / F.lit(float(total))
    chance = (n_pair + PRIOR * share) / (n_term + PRIOR)
    return F.struct((1 - F.log2(chance) / F.log2(share)).alias("disclosure"), chance.alias("chance"))


def _most_documents(total: int, n_entity: Column) -> Column:
    """A term in more documents cannot reach ``GENERALISE`` with an entity of so many."""
    share = n_entity / F.lit(float(total))
    # a little more than exact, for rounding
    return (n_entity + PRIOR * share) / F.pow(share, F.lit(1 - GENERALISE)) * (1 + 1e-6) - PRIOR


def _same_documents(rows: DataFrame, key: str, side: str) -> DataFrame:
    """Per ``key`` its class: two hashes of the set of texts (``digest``) it stands in."""
    return rows.groupBy(key).agg(*[
        F.bit_xor(F.xxhash64(F.lit(n), "digest")).alias(f"{side}{n}") for n in (1, 2)])


def disclosures(observed: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """Per digest of a text the ``known`` terms that disclose an entity in it: term, disclosure, chance.

    Terms too common to reach the threshold with any entity of their text go
    before pairs are made, first by how many texts with entities hold them, then
    by how many texts do. That changes no result: for a pair over the threshold
    all texts that hold it stay.
    """
    copies = materialize(observed.groupBy("digest").agg(F.count(F.lit(1)).alias("n_copies")).filter(
        "n_copies > 1"))
    total = observed.count() - (copies.agg(F.sum(F.col("n_copies") - 1)).first()[0] or 0)

    @F.pandas_udf("array<string>")
    def terms_of(texts: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([sorted({x for x, _, _ in find_terms(t, _as_spans(b))})
                          for t, b in zip(texts, base)])

    once = observed.filter(F.size("base") > 0).dropDuplicates(["digest"])
    once = materialize(once.select("digest", "entities", terms_of("text", "base").alias("terms")))
    held = materialize(once.select("digest", F.explode("entities").alias("entity")))
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).filter(
        F.col("n_entity") < total).withColumn("most", _most_documents(total, F.col("n_entity")))
    beside = ["digest", "e1", "e2", "n_entity", "most"]
    held = materialize(held.join(entities, "entity").join(
        _same_documents(held, "entity", "e"), "entity").select(beside).distinct())
    reach = held.groupBy("digest").agg(F.max("most").alias("reach"))
    words = once.select("digest", F.explode("terms").alias("term"))
    # both tables are written, so that a common word's rows can be split
    least = materialize(words.groupBy("term").agg(F.count(F.lit(1)).alias("n_least")))
    rare = materialize(words.join(least, "term").join(reach, "digest").filter(
        F.col("n_least") <= F.col("reach")).select("digest", "term", "reach"))
    n_term = materialize(_term_documents(docs, text, materialize(rare.select("term").distinct()), copies))
    placed = materialize(rare.join(n_term, "term").filter(F.col("n_term") <= F.col("reach")).drop("reach"))
    placed = materialize(placed.join(_same_documents(placed, "term", "t"), "term"))
    pair = ["e1", "e2", "t1", "t2", "n_term"]
    pairs = materialize(placed.select("digest", "t1", "t2", "n_term").distinct().join(held, "digest").filter(
        F.col("n_term") <= F.col("most")).drop("most"))
    score = _scores(total, F.first("n_entity"), F.count(F.lit(1)), F.first("n_term"))
    over = pairs.groupBy(pair).agg(score.alias("score")).filter(
        F.col("score.disclosure") >= GENERALISE)
    by_class = pairs.join(over, pair).groupBy("digest", "t1", "t2", "n_term").agg(
        F.max("score").alias("score"))
    return materialize(placed.join(by_class, ["digest", "t1", "t2", "n_term"]).groupBy("digest").agg(
        F.collect_list(F.struct("term", "score.disclosure", "score.chance")).alias("known")))


def _as_spans(base: list) -> list[tuple[str, int, int]]:
    return [(s["kind"], s["start"], s["end"]) for s in base]


def find_personal(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: struct ``row`` of the kept columns, ``base`` spans, disclosing ``terms``.

    ``terms`` are spans with their disclosure and chance, by start.
    """
    keep = docs.columns if keep is None else keep
    observed = _observed(docs, text, keep)

    @F.pandas_udf("array<struct<start: long, end: long, disclosure: double, chance: double>>")
    def places(texts: pd.Series, base: pd.Series, known: pd.Series) -> pd.Series:
        out = []
        for t, b, k in zip(texts, base, known):
            by_term = {x["term"]: x for x in k} if k is not None else {}
            found = find_terms(t, _as_spans(b)) if by_term else []
            out.append([{**by_term[x], "start": start, "end": end}
                        for x, start, end in found if x in by_term])
        return pd.Series(out)

    return observed.join(disclosures(observed, docs, text), "digest", "left").select(
        "row", "base", places("text", "base", "known").alias("terms"))


def sanitised(text: str | None, base: list, terms: list) -> str | None:
    """The text with entities replaced by their kind and terms generalised or removed."""
    if text is None:
        return None
    marks = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in base]
    for s in terms:
        word = text[s["start"]:s["end"]]
        general = ("[NUMBER]" if any(c.isdigit() for c in word)
                   else "[NAME]" if word[:1].isupper() else "[WORD]")
        marks.append((s["start"], s["end"], "" if s["chance"] >= REMOVE else general))
    out, at = [], 0
    for start, end, mark in sorted(marks):
        if start >= at:
            out.append(text[at:start] + mark)
        at = max(at, end)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents, same columns, with sanitised texts."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
        return pd.Series([sanitised(*x) for x in zip(texts, base, terms)], dtype=object)

    found = find_personal(docs, text)
    field = F.col("row").getField(text)
    return found.withColumn("_clean", clean(field, "base", "terms")).select(*[
        F.col("_clean").alias(c) if c == text else F.col("row").getField(c).alias(c)
        for c in docs.columns])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the terms that give it away."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal(docs, keep=["doc_id"])
    terms = F.transform("terms", lambda t: F.struct(
        F.lit(TERM).alias("kind"), t.start.alias("start"), t.end.alias("end")))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[sp.count_of("base", k).alias(f"n_{k}") for k in BASE],
        sp.digest(F.col("base")).alias("base_sha256"),
        sp.joined(F.concat("base", terms)).alias("spans"))
