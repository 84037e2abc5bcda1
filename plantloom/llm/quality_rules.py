"""Quality rules as a ledger: each rule is evaluated once, decisions come later.

The ledger holds per document the measurements and a bitmask of failed rules.
A policy is a named, versioned set of rules, that is a mask; applying one, or
asking what dropping a rule from it would change, reads the ledger's bits only.

DataFrame functions only; nothing is shuffled to build the ledger, and the work
per text is its length times the logarithm of it at most, whatever repeats.

Defined results: null counts as empty, and a text without words has all counts
zero and fails ``few_words`` only. Repeated rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.tables import packed, quoted, read, text_of

SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Struct ``row`` of all columns, and the measurements as columns.

    n_words, word_chars, n_symbols, n_upper, n_letters, n_lines, n_dup_lines and
    n_repeat_words: words inside ``WINDOW``-word windows that occur twice or more.
    """
    one = packed(docs, text=text_of(quoted(text)))
    two = one.select(
        "row", "text",
        F.filter(F.split("text", SPACES, -1), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(NOT_SPACE)).alias("lines"))
    count = F.size("words")
    three = two.select(
        "row", count.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"\p{L}")).cast("long").alias("n_letters"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # the hash of each window stands for it
        F.when(count < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.slice("words", 1, F.greatest(count - WINDOW + 1, F.lit(0))),
            lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, WINDOW)])))
        .alias("windows"))
    # windows with their places, in order, so that equal ones are neighbours; only if any are equal
    placed = "array<struct<h: bigint, i: int>>"
    four = three.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast(placed))).drop("windows")
    five = four.withColumn("places", F.sort_array(F.filter(F.transform(
        "sorted", lambda s, k: F.when(
            F.coalesce(F.get("sorted", k + 1).h == s.h, F.lit(False))
            | F.coalesce(F.when(k > 0, F.get("sorted", k - 1).h == s.h), F.lit(False)), s.i)),
        lambda p: p.isNotNull()))).drop("sorted")
    # each place adds the words up to the next place, a whole window at most
    return five.withColumn("n_repeat_words", F.aggregate(
        F.transform("places", lambda p, k: F.coalesce(
            F.least(F.get("places", k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)).cast("long")),
        F.lit(0).cast("long"), lambda total, x: total + x)).drop("places")


def _rules() -> dict[str, Column]:
    """Rule i sets bit i of ``failed``. New rules go to the end: old ledgers stay readable."""
    c = F.col
    return {
        "few_words": c("n_words") < 10,
        "repeats": 100 * c("n_repeat_words") > 20 * c("n_words"),
        "symbols": 5 * c("n_symbols") > c("n_words"),
        "shouting": (c("n_letters") >= 20) & (2 * c("n_upper") > c("n_letters")),
        "dup_lines": 2 * c("n_dup_lines") > c("n_lines"),
        "word_length": (c("word_chars") > 20 * c("n_words")) | (c("word_chars") < 2 * c("n_words")),
    }


BASE = ("few_words", "repeats")
POLICIES = {
    "base": BASE,
    "2026-01": (*BASE, "symbols", "shouting"),
    "2026-02": (*BASE, "symbols", "shouting", "dup_lines", "word_length"),
}
POLICY = "2026-02"


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row``, the measurements, and ``failed``: bit i is set if rule i fails.

    Store it (``materialize``, or a table) before applying several policies or an ablation, or
    each of them measures the texts anew; a filter on a ledger not stored is slow, as Spark
    pushes the measurements into it.
    """
    bits = [F.when(rule, F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
            for i, rule in enumerate(_rules().values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs, text).withColumn("failed", total)


def mask(policy: str) -> int:
    names = list(_rules())
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def passes(policy: str) -> Column:
    """Whether a ledger row passes every rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def only_rule(policy: str = POLICY) -> Column:
    """The rule of the policy that alone rejects a ledger row; null if none or several do."""
    names, failed = list(_rules()), F.col("failed").bitwiseAND(F.lit(mask(policy)))
    return F.coalesce(*[F.when(failed == 1 << names.index(rule), F.lit(rule)) for rule in POLICIES[policy]])


def ablation(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """Per rule of the policy: rows it fails, and rows that only it fails (kept without it).

    One aggregation over the distinct bitmasks, of which there are few.
    """
    masks = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy))).alias("failed")).agg(
        F.count(F.lit(1)).alias("n"))
    names = list(_rules())
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    each = masks.select("failed", "n", F.explode(rules).alias("r"))
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy("r.rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of every document, the current and each other policy's verdict, and the rule it hangs on.

    ``only_rule`` names the rule without which the current policy would keep the document.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ledger(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", (~passes("base")).alias("base_failed"), passes(POLICY).alias("kept"),
        F.col("failed").alias("failed_rules"), only_rule().alias("only_rule"),
        *[passes(policy).alias("kept_" + policy.replace("-", "_")) for policy in POLICIES])


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
w AS (SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM t WHERE len(words) >= 5),
h AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS shingle FROM w),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, shingle) AS n FROM h) WHERE n > 1),
covered AS (
  SELECT r, sum(least(5, coalesce(lead_i - i, 5))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS lead_i FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         len(regexp_extract_all(text, '\p{Lu}')) AS n_upper,
         len(regexp_extract_all(text, '\p{L}')) AS n_letters,
         len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN covered USING (r)),
f AS (
  SELECT *, n_words < 10 AS few, 100 * n_repeat_words > 20 * n_words AS rep, 5 * n_symbols > n_words AS sym,
         n_letters >= 20 AND 2 * n_upper > n_letters AS loud, 2 * n_dup_lines > n_lines AS dup,
         word_chars > 20 * n_words OR word_chars < 2 * n_words AS odd
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few OR rep AS base_failed,
       NOT (few OR rep OR sym OR loud OR dup OR odd) AS kept,
       CAST(few::INT + 2 * rep::INT + 4 * sym::INT + 8 * loud::INT + 16 * dup::INT + 32 * odd::INT AS BIGINT)
         AS failed_rules,
       CASE few::INT + rep::INT + sym::INT + loud::INT + dup::INT + odd::INT WHEN 1 THEN
         CASE WHEN few THEN 'few_words' WHEN rep THEN 'repeats' WHEN sym THEN 'symbols'
              WHEN loud THEN 'shouting' WHEN dup THEN 'dup_lines' ELSE 'word_length' END END AS only_rule,
       NOT (few OR rep) AS kept_base, NOT (few OR rep OR sym OR loud) AS kept_2026_01,
       NOT (few OR rep OR sym OR loud OR dup OR odd) AS kept_2026_02
FROM f
"""
