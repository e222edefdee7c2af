"""Transaction and client metrics.

Every grouped metric can be computed straight from its table, or from a small cube that one scan
of the table fills (``transaction_cube``, ``client_cube``). Jobs use the cubes: all metrics of a
table then cost one scan and one shuffle of partly aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelake.functions.numbers import (
    band,
    decimal_share_pct,
    double_share_pct,
    safe_ratio,
    width_bucket_floor,
)
from swipelake.functions.text import flag

# Fixed value: the text that marks a fraudulent transaction.
FRAUD = "Yes"


def _mean(col: Column | str, digits: int = 2) -> Column:
    return F.round(F.avg(col), digits)


# --- straight from the table ---------------------------------------------------------------


def yearly_metrics(
    tx: DataFrame,
    date: str = "date",
    amount: str = "amount",
    fraud: str = "has_fraud",
    fraud_value: str = FRAUD,
) -> DataFrame:
    """Count, sum, mean and fraud percentage by year of the transaction date."""
    hits = F.sum(flag(fraud, fraud_value))
    return (
        tx.groupBy(F.year(date).alias("year"))
        .agg(
            F.count("*").alias("total_transactions"),
            F.round(F.sum(amount), 2).alias("total_amount"),
            _mean(amount).alias("avg_amount"),
            decimal_share_pct(hits, F.count("*")).alias("pct_fraud"),
        )
        .orderBy("year")
    )


def category_metrics(
    tx: DataFrame,
    category: str = "use_chip",
    amount: str = "amount",
    fraud: str = "has_fraud",
    fraud_value: str = FRAUD,
) -> DataFrame:
    """Count, fraud percentage and mean amount by category."""
    hits = F.sum(flag(fraud, fraud_value))
    return tx.groupBy(category).agg(
        F.count("*").alias("total_transactions"),
        double_share_pct(hits, F.count("*")).alias("fraud_pct"),
        _mean(amount).alias("avg_amount"),
    )


def group_means(df: DataFrame, key: Column | str, means: dict[str, str], count: str | None = None) -> DataFrame:
    """Rounded means by key; ``means`` maps result names to columns."""
    aggs = [_mean(col).alias(name) for name, col in means.items()]
    if count:
        aggs.append(F.count("*").alias(count))
    return df.groupBy(key).agg(*aggs)


def bucket_metrics(
    df: DataFrame, value: str, means: dict[str, str], width: int = 10, bucket: str = "age_bucket", count: str = "total"
) -> DataFrame:
    """Rounded means and a count by bucket of equal width, in bucket order."""
    return group_means(df, width_bucket_floor(value, width).alias(bucket), means, count).orderBy(bucket)


def band_metrics(
    df: DataFrame,
    score: str,
    means: dict[str, str],
    bounds=None,
    band_name: str = "score_band",
    count: str = "num_customers",
) -> DataFrame:
    """Rounded means and a count by named band."""
    return group_means(df, band(score, bounds).alias(band_name), means, count)


def ratio_stats(
    df: DataFrame, numerator: str, denominator: str, avg_name: str = "avg_dti", max_name: str = "max_dti"
) -> DataFrame:
    """Mean and maximum of a ratio over the whole table; rows without a ratio do not count."""
    ratio = safe_ratio(numerator, denominator)
    return df.agg(_mean(ratio).alias(avg_name), F.round(F.max(ratio), 2).alias(max_name))


def difference_stats(df: DataFrame, left: Column, right: Column, suffix: str = "years_left") -> DataFrame:
    """Mean, minimum and maximum of a difference over the whole table."""
    diff = left - right
    return df.agg(
        _mean(diff).alias(f"avg_{suffix}"),
        F.min(diff).alias(f"min_{suffix}"),
        F.max(diff).alias(f"max_{suffix}"),
    )


def client_totals(tx: DataFrame, client: str = "client_id", amount: str = "amount", total: str = "total_sent") -> DataFrame:
    return tx.groupBy(client).agg(F.sum(amount).alias(total))


# --- one scan of transactions, many metrics -----------------------------------------------


def transaction_cube(
    tx: DataFrame,
    date: str = "date",
    category: str = "use_chip",
    amount: str = "amount",
    fraud: str = "has_fraud",
    fraud_value: str = FRAUD,
) -> DataFrame:
    """Additive parts of the transaction metrics by (year, category)."""
    return tx.groupBy(F.year(date).alias("year"), F.col(category).alias("category")).agg(
        F.count("*").alias("n"),
        F.sum(flag(fraud, fraud_value)).alias("hits"),
        F.sum(amount).alias("amount_sum"),
        F.count(amount).alias("amount_n"),
    )


def _part_mean(total: str, n: str) -> Column:
    return F.round(F.try_divide(F.sum(total), F.sum(n)), 2)


def yearly_from_cube(cube: DataFrame) -> DataFrame:
    return (
        cube.groupBy("year")
        .agg(
            F.sum("n").alias("total_transactions"),
            F.round(F.sum("amount_sum"), 2).alias("total_amount"),
            _part_mean("amount_sum", "amount_n").alias("avg_amount"),
            decimal_share_pct(F.sum("hits"), F.sum("n")).alias("pct_fraud"),
        )
        .orderBy("year")
    )


def category_from_cube(cube: DataFrame, category: str = "use_chip") -> DataFrame:
    return cube.groupBy(F.col("category").alias(category)).agg(
        F.sum("n").alias("total_transactions"),
        double_share_pct(F.sum("hits"), F.sum("n")).alias("fraud_pct"),
        _part_mean("amount_sum", "amount_n").alias("avg_amount"),
    )


# --- one scan of clients, many metrics ----------------------------------------------------

_CUBE_MEASURES = {"debt": "total_debt", "income": "yearly_income", "score": "credit_score"}


def client_cube(users: DataFrame) -> DataFrame:
    """Additive parts of all client metrics by (gender, age bucket, score band)."""
    ratio = safe_ratio("total_debt", "yearly_income")
    left = F.col("retirement_age") - F.col("current_age")
    parts = [F.count("*").alias("n")]
    for short, col in _CUBE_MEASURES.items():
        parts += [F.sum(col).alias(f"{short}_sum"), F.count(col).alias(f"{short}_n")]
    parts += [
        F.sum(ratio).alias("ratio_sum"),
        F.count(ratio).alias("ratio_n"),
        F.max(ratio).alias("ratio_max"),
        F.sum(left).alias("left_sum"),
        F.count(left).alias("left_n"),
        F.min(left).alias("left_min"),
        F.max(left).alias("left_max"),
    ]
    return users.groupBy(
        "gender",
        width_bucket_floor("current_age").alias("age_bucket"),
        band("credit_score").alias("score_band"),
    ).agg(*parts)


def client_metrics_from_cube(cube: DataFrame) -> dict[str, DataFrame]:
    """The five client metric tables, by table name."""
    debt = _part_mean("debt_sum", "debt_n")
    income = _part_mean("income_sum", "income_n")
    score = _part_mean("score_sum", "score_n")
    return {
        "gender_metrics": cube.groupBy("gender").agg(
            debt.alias("avg_total_debt"), score.alias("avg_credit_score"), income.alias("avg_yearly_income")
        ),
        "dti_metrics": cube.agg(
            _part_mean("ratio_sum", "ratio_n").alias("avg_dti"), F.round(F.max("ratio_max"), 2).alias("max_dti")
        ),
        "age_bucket_metrics": cube.groupBy("age_bucket")
        .agg(
            income.alias("avg_income"),
            debt.alias("avg_debt"),
            score.alias("avg_credit_score"),
            F.sum("n").alias("total"),
        )
        .orderBy("age_bucket"),
        "score_classification": cube.groupBy("score_band").agg(
            income.alias("avg_income"), debt.alias("avg_debt"), F.sum("n").alias("num_customers")
        ),
        "retirement_stats": cube.agg(
            _part_mean("left_sum", "left_n").alias("avg_years_left"),
            F.min("left_min").alias("min_years_left"),
            F.max("left_max").alias("max_years_left"),
        ),
    }
