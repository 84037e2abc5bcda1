"""Left outer joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most keys a sketch names, and items it tracks: its counts are off by some 0.02 % of its rows.
HEAVY_KEYS, TRACKED = 1000, 10000
# Buckets of the count that comes first, if the shuffle does not call for more.
LEAST_BUCKETS = 4096


def left_lookup(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Left outer equi-join whose sides are both shuffled for it.

    Joined plainly, Spark would reuse the distribution an earlier grouping or
    join by the same keys left behind, and a join without a shuffle right below
    each side is not split when one key holds much of the left. Null-safe
    comparison is another key expression, so both sides are shuffled; with no
    null keys on the right it selects the same pairs.
    """
    for _, key in on:
        right = right.filter(F.col(key).isNotNull())
    return left.join(right, [F.col(a).eqNullSafe(F.col(b)) for a, b in on], "left")


def heavy_keys(df: DataFrame, columns: Sequence[str], parts: int) -> dict[str, int]:
    """Keys that fill more than one of ``parts`` even shares of the rows, and salts for each.

    Counts per hash bucket tell whether there are any; only the rows of full
    buckets go through a frequent-items sketch. Both start in the map tasks and
    read the key columns only. What reaches the driver is a count per bucket and
    ``HEAVY_KEYS`` keys at most, whatever the table's size. Keys with a null are
    no keys.
    """
    keyed, bucket = df.select(_one_key(columns).alias("k")).dropna(), _bucket(parts)
    counts = {r.b: r["count"] for r in keyed.groupBy(bucket.alias("b")).count().collect()}
    total = sum(counts.values())
    full = [b for b, n in counts.items() if n * parts > total]
    if not full:
        return {}
    top = keyed.filter(bucket.isin(full)).agg(
        F.expr(f"approx_top_k(k, {HEAVY_KEYS}, {TRACKED})").alias("top")).first().top
    return {t["item"]: ceil(2 * t["count"] * parts / total) for t in top if t["count"] * parts > total}


def heavy_right(right: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """The ``heavy_keys`` of a join's right side at the session's number of partitions.

    None, and no job, if all of it is smaller than what Spark calls a skewed partition.
    """
    return heavy_keys(right, columns, _parts(right)) if _may_be_skewed(right) else {}


def uneven(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether some key, or the rows without one, would make what Spark calls a skewed partition.

    Counts per hash bucket, as in ``heavy_keys``; a table smaller than such a partition is not read.
    """
    if not _may_be_skewed(df):
        return False
    parts = _parts(df)
    factor = float(df.sparkSession.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor"))
    counts = df.select(_one_key(columns).alias("k")).groupBy(_bucket(parts).alias("b")).count()
    most, total = counts.agg(F.max("count"), F.sum("count")).first()
    return bool(total) and most * parts > factor * total


def left_join_many(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    name: str = "right",
    again: bool = False,
    heavy: dict[str, int] | None = None,
) -> DataFrame:
    """Left outer equi-join for a right side with any number of rows per key.

    Adaptive execution can split a heavy key of an outer join on the preserved
    side only, so a key with very many right rows would end in one task. Right
    rows of such keys get one of several salts, left rows of them come once per
    salt, and everything is one left join on key and salt. A heavy key has
    right rows, so copies of a left row that meet none can go. All other rows
    have salt 0 and are joined as usual; without heavy keys there are no salts.

    The heavy keys are looked up while the plan is built, in a small job, unless
    all of the right side is smaller than what Spark calls a skewed partition.
    They are a table in the plan, the same for both sides, and bounded, as
    ``heavy_keys`` says, so it is broadcast. A key that is heavy on the left is
    split by adaptive execution; ``again`` says that the left side went through
    a join by this key before and must be shuffled anew for that. The right
    side's columns are qualified by ``name``; its rows with a null key match
    nothing.
    """
    spark = left.sparkSession
    mine, theirs = [a for a, _ in on], [b for _, b in on]
    for key in theirs:
        right = right.filter(F.col(key).isNotNull())
    if heavy is None:
        heavy = heavy_right(right, theirs)
    qualified = [(a, f"{name}.{b}") for a, b in on]
    if not heavy:
        if again:
            return left_lookup(left, right.alias(name), qualified)
        return left.join(right.alias(name), [F.col(a) == F.col(b) for a, b in qualified], "left")

    key, salt, at = f"_key_{name}", f"_salt_{name}", f"_at_{name}"
    known = F.broadcast(spark.createDataFrame(list(heavy.items()), "key string, salts int"))
    every = known.select(F.col("key").alias(key),
                         F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias(salt))
    copies = left.join(F.broadcast(every), _one_key(mine) == F.col(key), "left").withColumn(
        salt, F.coalesce(salt, F.lit(0)))
    # by place and content, so that neither sorted input nor equal rows end in one salt
    place = F.spark_partition_id() + F.xxhash64(*[F.col(c) for c in right.columns])
    salted = right.join(known, _one_key(theirs) == F.col("key"), "left").select(
        *right.columns, F.coalesce(F.pmod(place, F.col("salts")), F.lit(0)).cast("int").alias(at))
    joined = copies.join(salted.alias(name), [
        F.col(a) == F.col(b) for a, b in [*qualified, (salt, f"{name}.{at}")]], "left")
    found = F.col(qualified[0][1]).isNotNull()
    return joined.filter(F.col(key).isNull() | found).drop(key, salt, at)


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bucket(parts: int) -> Column:
    """Hash bucket of a key in column ``k``."""
    return F.pmod(F.xxhash64("k"), F.lit(max(LEAST_BUCKETS, 4 * parts)))


def _may_be_skewed(df: DataFrame) -> bool:
    """Whether Spark expects more bytes than its bound for a skewed partition."""
    bound = df.sparkSession.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    spark_bytes = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    expected = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(expected)) > spark_bytes(bound)


def _one_key(columns: Sequence[str]) -> Column:
    """One string per combination of values; null where one of them is."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[part for t in texts for part in (F.length(t).cast("string"), F.lit(":"), t)])
