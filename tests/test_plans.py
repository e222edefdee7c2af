"""What reaches the scan, and what is shuffled."""

import pytest

from swipelake import queries as registered

SF = "/root/testdata/sf0.001"


@pytest.fixture
def formatted(spark):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return lambda df: df._jdf.queryExecution().explainString(mode)


def run(spark, name):
    return registered.queries()[name](spark, SF)


@pytest.mark.parametrize(
    ("name", "text"),
    [
        ("page_keyset", "GreaterThan(o_orderkey,149)"),
        ("client_transactions", "EqualTo(o_custkey,7)"),
        ("point_lookup", "EqualTo(o_orderkey,42)"),
        ("latest_snapshot", "EqualTo(o_orderdate,ScalarSubquery"),
        ("page", "GreaterThanOrEqual(o_orderkey,100), LessThanOrEqual(o_orderkey,149)"),
        ("error_split", "EqualTo(event_type,error)"),
    ],
)
def test_filter_reaches_the_scan(spark, formatted, name, text):
    assert text in formatted(run(spark, name))


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("yearly_metrics", "struct<o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>"),
        ("ratio_stats", "struct<l_discount:double,l_tax:double>"),
        ("hash_sample", "struct<o_orderkey:bigint,o_totalprice:double>"),
        ("class_distribution", "struct<quality:int>"),
        ("label_enrich", "struct<doc_id:bigint,lang:string,source:string>"),
    ],
)
def test_only_needed_columns_are_read(spark, formatted, name, columns):
    assert f"ReadSchema: {columns}" in formatted(run(spark, name))


@pytest.mark.parametrize("name", ["yearly_metrics", "category_metrics", "client_totals", "confusion", "bucket_metrics"])
def test_rows_are_combined_before_the_shuffle(spark, formatted, name):
    assert "partial_" in formatted(run(spark, name))


@pytest.mark.parametrize("name", ["money_parse", "mask", "error_split", "hash_sample", "year_month", "json_map_explode"])
def test_row_wise_work_needs_no_shuffle(spark, formatted, name):
    plan = formatted(run(spark, name))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - {"class_neighbours", "synthetic_points"}))
def test_no_python_rows_and_no_cross_join(spark, formatted, name):
    if name in ("forest_predictions", "forest_vectors", "fraud_model", "fraud_model_rows", "fraud_balanced", "balanced_counts", "hashed_recall"):
        pytest.skip("trains or searches neighbours")
    plan = formatted(run(spark, name))
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
