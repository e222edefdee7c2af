"""Samples and splits whose outcome depends only on the rows' keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipelake.functions.hashing import TWO_POW_32, digest_word, key_digest
from swipelake.operators.joins import broadcast_if_small
from swipelake.session import cut_lineage

# Leading hex digits of the digest that form a bucket: 16^4 buckets per stratum.
BUCKET_DIGITS = 4


def _check_percentage(percentage: float) -> None:
    if not 0 < percentage <= 100:
        raise ValueError("percentage must be above 0 and at most 100")


def bernoulli_sample(df: DataFrame, percentage: float, seed: int | None = None) -> DataFrame:
    """Each row is kept with the given chance; 100 keeps all."""
    _check_percentage(percentage)
    return df if percentage == 100 else df.sample(False, percentage / 100.0, seed)


def hash_sample(df: DataFrame, key: str, percentage: float) -> DataFrame:
    """As ``bernoulli_sample``, drawn from the key: a row is always in or always out, and a
    larger percentage keeps the rows of a smaller one."""
    _check_percentage(percentage)
    if percentage == 100:
        return df
    return df.where(digest_word(key_digest(key), 0) < F.lit(int(TWO_POW_32 * percentage / 100.0)))


def quota_cutoffs(
    df: DataFrame, stratum: str, key: str, quotas: DataFrame, weight: Column | None = None
) -> DataFrame:
    """Where each stratum's quota ends when its rows stand in digest order.

    ``quotas`` holds (stratum, quota). The result has one row per stratum with a positive quota:
    ``cut_digest`` and ``cut_key`` of the last row inside, and ``cut_grant``, the part of that
    row's weight that still fits.

    A stratum may hold nearly all rows, so no window ever sees a whole stratum: rows are counted
    per digest bucket (a map-side combine), the bucket in which the quota ends is found from the
    counts, and only this bucket, one of 65,536, is put in order.

    Keys must not be null, and the key at a cut must not repeat: both fail the query, as the
    quota could not be met exactly.
    """
    w = F.lit(1) if weight is None else weight
    digest = F.coalesce(key_digest(key), F.raise_error(F.lit(f"a row has no {key}")).cast("string"))
    rows = df.select(
        F.col(stratum).alias("stratum"), digest.alias("digest"), F.col(key).alias("key"), w.cast("bigint").alias("w")
    ).withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    in_order = Window.partitionBy("stratum").orderBy("bucket")
    ends = (
        rows.groupBy("stratum", "bucket")
        .agg(F.sum("w").alias("w"))
        .withColumn("upto", F.sum("w").over(in_order))
        .withColumn("total", F.sum("w").over(Window.partitionBy("stratum")))
        .join(quotas.select(F.col(stratum).alias("q_stratum"), "quota"), F.col("stratum").eqNullSafe(F.col("q_stratum")))
        .withColumn("quota", F.least("quota", "total"))
        .where((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("w") < F.col("quota")))
        .select("q_stratum", F.col("bucket").alias("cut_bucket"), (F.col("quota") - F.col("upto") + F.col("w")).alias("open"))
    )
    # one small row per stratum: with it broadcast, the rows are filtered where they are
    ends = broadcast_if_small(cut_lineage(ends))
    last_bucket = rows.join(
        ends, F.col("stratum").eqNullSafe(F.col("q_stratum")) & (F.col("bucket") == F.col("cut_bucket"))
    )
    running = F.sum("w").over(
        Window.partitionBy("stratum").orderBy("digest", "key").rowsBetween(Window.unboundedPreceding, 0)
    )
    repeats = F.concat(F.lit(f"{key} repeats where a quota ends: "), F.col("key").cast("string"))
    once = F.when(F.count("*").over(Window.partitionBy("stratum", "digest", "key")) == 1, F.col("key"))
    return (
        last_bucket.withColumn("upto", running)
        .withColumn("once", once)
        .where((F.col("upto") >= F.col("open")) & (F.col("upto") - F.col("w") < F.col("open")))
        .select(
            F.col("stratum").alias("cut_stratum"),
            F.col("digest").alias("cut_digest"),
            F.coalesce("once", F.raise_error(repeats).cast(df.schema[key].dataType)).alias("cut_key"),
            (F.col("open") - F.col("upto") + F.col("w")).alias("cut_grant"),
        )
    )


def grant_quotas(
    df: DataFrame, stratum: str, key: str, quotas: DataFrame, weight: Column | None = None, granted: str = "granted"
) -> DataFrame:
    """Add the part of each row's weight (1 by default) that its stratum's quota covers, taking
    rows in digest order. Exact: per stratum the parts add up to the quota. The rows of ``df``
    are not shuffled: each looks up the one cut-off of its stratum, a table of one row per class."""
    w = F.lit(1) if weight is None else weight
    cuts = broadcast_if_small(cut_lineage(quota_cutoffs(df, stratum, key, quotas, weight)))
    digest = F.col("_digest")
    before = (digest < F.col("cut_digest")) | ((digest == F.col("cut_digest")) & (F.col(key) < F.col("cut_key")))
    at_cut = (digest == F.col("cut_digest")) & (F.col(key) == F.col("cut_key"))
    part = F.when(before, w).when(at_cut, F.col("cut_grant")).otherwise(0)
    return (
        df.withColumn("_digest", key_digest(key))
        .join(cuts, F.col(stratum).eqNullSafe(F.col("cut_stratum")), "left")
        .withColumn(granted, part.cast("bigint"))
        .drop("_digest", "cut_stratum", "cut_digest", "cut_key", "cut_grant")
    )


def split_quotas(counts: DataFrame, label: str, fraction: float) -> DataFrame:
    """Test rows per class: their sum is the rounded-up fraction of all rows, shared out in
    proportion, left-over rows to the largest remainders. ``counts`` holds (label, n), one row
    per class."""
    everything = Window.partitionBy()
    wide = "decimal(38,0)"
    shared = (
        counts.withColumn("all_rows", F.sum("n").over(everything))
        .withColumn("test_rows", F.ceil(F.col("all_rows") * F.lit(fraction)))
        .withColumn("share", F.col("n").cast(wide) * F.col("test_rows").cast(wide))
        .withColumn("remainder", F.col("share") % F.col("all_rows"))
        .withColumn("base", ((F.col("share") - F.col("remainder")) / F.col("all_rows")).cast("bigint"))
        .withColumn("left_over", F.col("test_rows") - F.sum("base").over(everything))
        .withColumn("place", F.row_number().over(Window.orderBy(F.desc("remainder"), F.asc(label))))
    )
    return shared.select(label, (F.col("base") + (F.col("place") <= F.col("left_over")).cast("int")).alias("quota"))


def stratified_split(
    df: DataFrame, label: str, key: str, fraction: float = 0.2, is_test: str = "is_test"
) -> DataFrame:
    """Mark the test rows: an exact share of every class, drawn by key digest.

    Label and key are read three times to find the cut-offs, so ``df`` should be a stored table.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    marked = grant_quotas(df, label, key, split_quotas(counts, label, fraction), granted="_in_test")
    return marked.withColumn(is_test, F.col("_in_test") > 0).drop("_in_test")


def sample_by_chance(df: DataFrame, stratum: str, key: str, chances: dict, otherwise: float = 0.0) -> DataFrame:
    """Each row stays with the chance of its stratum, drawn from its key: one pass, no counts, about the asked share of each.

    As ``sampleBy`` of a DataFrame, but a row is always in or always out, and a larger chance keeps the rows of a smaller one. A
    null stratum and those without a chance have ``otherwise``; a null key counts as empty text.
    """
    if wrong := [c for c in [*chances.values(), otherwise] if not 0 <= c <= 1]:
        raise ValueError(f"a chance of {wrong[0]}")
    draw = digest_word(F.coalesce(key_digest(key), F.md5(F.lit(""))), 0)
    upto = F.lit(int(TWO_POW_32 * otherwise))
    for value, chance in chances.items():
        upto = F.when(F.col(stratum) == F.lit(value), F.lit(int(TWO_POW_32 * chance))).otherwise(upto)
    return df.where(draw < upto)


def split_by_chance(df: DataFrame, key: str, fraction: float = 0.2, is_test: str = "is_test") -> DataFrame:
    """Mark about a share of the rows of every class, drawn from the key in one pass.

    One chance serves all classes, so no class is counted. ``stratified_split`` marks exact shares.
    """
    if not 0 < fraction < 1:
        raise ValueError("fraction must be between 0 and 1")
    draw = digest_word(F.coalesce(key_digest(key), F.md5(F.lit(""))), 0)
    return df.withColumn(is_test, draw < F.lit(int(TWO_POW_32 * fraction)))
