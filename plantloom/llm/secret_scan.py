"""Secret scan: Aho-Corasick keywords, anchored patterns at the hits, checksums inside tokens.

One automaton pass over the lower-cased text finds where a secret could begin;
only there is a kind's pattern tried, anchored. Plain hex runs have no keyword:
their prefilter looks at every sixth character, because a run of 24 covers four
neighbouring ones. Tokens that carry a checksum count only if it is right.

Kinds: ``assign`` (name, sign, value of 6 or more characters), ``access`` (key
ids of 20 or more), ``hex`` (runs of 24 or more), then ``github`` and ``npm``
(36 letters and digits after the prefix, the last six being the CRC-32 of the
other thirty). Per kind, matches are leftmost and do not overlap; a match that
fails its check is dropped and not retried. Kinds may overlap one another.

Null and empty texts have no spans. Time is linear in the text.
"""

from __future__ import annotations

import re
import zlib

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm import spans as sp
from plantloom.llm.tables import read, ready_for_python

# Kinds in their order, keywords, patterns, least lengths.
KINDS = ("assign", "access", "hex", "github", "npm")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
}
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]+)")
VALUE_LEAST, ACCESS_LEAST, TOKEN_BODY, TOKEN_CHECK = 6, 20, 30, 6
STRIDE = 6
SAMPLED = re.compile(r"[0-9a-f]{4,}")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _automaton() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        words.add_word(word, (kind, len(word)))
    words.make_automaton()
    return words


WORDS = _automaton()


def checksum(body: str) -> str:
    """CRC-32 of a token's random part as six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(TOKEN_CHECK):
        value, digit = divmod(value, len(DIGITS))
        out = DIGITS[digit] + out
    return out


def _valid_token(found: re.Match) -> bool:
    body = found[1]
    return (len(body) == TOKEN_BODY + TOKEN_CHECK
            and body[TOKEN_BODY:] == checksum(body[:TOKEN_BODY]))


# Per keyword kind: anchored pattern, and the check a match must pass.
RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= VALUE_LEAST),
    "access": (ACCESS, lambda m: len(m[0]) >= ACCESS_LEAST),
    "github": (TOKEN, _valid_token),
    "npm": (TOKEN, _valid_token),
}


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All spans, by start, then kind."""
    if not text:
        return []
    found = []
    free = dict.fromkeys(RULES, 0)
    # one character becomes two in lower case; any other single letter keeps the places
    low = text.replace("İ", "I").lower()
    for last, (kind, size) in WORDS.iter(low):
        start = last - size + 1
        if start < free[kind]:
            continue
        pattern, passes = RULES[kind]
        match = pattern.match(text, start)
        if match:
            free[kind] = match.end()
            if passes(match):
                found.append((kind, start, match.end()))
    for run in SAMPLED.finditer(text[::STRIDE]):
        first, after = (run.start() - 1) * STRIDE + 1, run.end() * STRIDE
        found.extend(("hex", m.start(), m.end())
                     for m in HEX.finditer(text, max(0, first), after))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(spark: SparkSession):
    """A column function text -> spans."""
    ready_for_python(spark)

    @F.pandas_udf(sp.TYPE)
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([sp.as_rows(find_secrets(t)) for t in texts])

    return scan


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", secret_spans(spark)("text").alias("spans"))
    base = sp.of_kinds("spans", ["assign", "access", "hex"])
    return found.select(
        "doc_id", sp.count_of("spans", "assign").alias("n_assign"),
        sp.count_of("spans", "access").alias("n_access"),
        sp.count_of("spans", "hex").alias("n_hex"),
        sp.digest(base).alias("base_sha256"), sp.joined(F.col("spans")).alias("spans"))
