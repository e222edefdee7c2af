import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from swipelake.functions.numbers import band, decimal_share_pct, double_share_pct, safe_ratio, width_bucket_floor
from swipelake.functions.text import currency_mark, flag, has_text, mask_card, parse_money
from swipelake.operators.dictionaries import explode_map, json_object_to_rows


def values(spark, inputs, kind, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [tuple(r) for r in df.orderBy("i").select(*exprs).collect()]


MONEY = ["$24295", "$1,234.50", "$-77.00", "12.5", "$", "", None, "1-2", "1.2.3"]


def test_money(spark):
    got = [r[0] for r in values(spark, MONEY, "string", parse_money("v"))]
    assert got == [24295.0, 1234.5, -77.0, 12.5, None, None, None, None, None]


def test_currency(spark):
    got = values(spark, MONEY[:7], "string", currency_mark("v"), currency_mark("v", keep_sign=False))
    assert [g[0] for g in got] == ["$", "$", "$-", "", "$", "", None]
    assert [g[1] for g in got] == ["$", "$", "$", "", "$", "", None]


def test_money_inverts_formatting(spark):
    rng = random.Random(7)
    numbers = [round(rng.uniform(-1e6, 1e6), 2) for _ in range(300)]
    got = values(spark, [f"${n:,.2f}" for n in numbers], "string", parse_money("v"))
    assert [g[0] for g in got] == numbers


def test_mask(spark):
    got = values(spark, ["4344676511950444", "123", "12", "", None], "string", mask_card("v"))
    assert [g[0] for g in got] == ["*" * 13 + "444", "123", "12", "", None]
    assert values(spark, [4344676511950444, None], "bigint", mask_card("v")) == [("*" * 13 + "444",), (None,)]


def test_mask_agrees_with_pattern(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("0123456789ab ") for _ in range(rng.randint(0, 24))) for _ in range(200)]
    for plain, pattern in values(spark, texts, "string", mask_card("v"), F.regexp_replace("v", r".(?=.{3})", "*")):
        assert plain == pattern


def test_text_and_flag(spark):
    got = values(spark, [None, "", "Bad PIN", "Yes"], "string", has_text("v"), flag("v", "Yes"))
    assert got == [(False, 0), (False, 0), (True, 0), (True, 1)]


def test_bands_and_buckets(spark):
    got = values(spark, [579, 580, 669, 670, 739, 740, None], "int", band("v"))
    assert [g[0] for g in got] == ["Poor", "Fair", "Fair", "Good", "Good", "Excellent", "Excellent"]
    assert values(spark, [19, 20, 53, None], "int", width_bucket_floor("v")) == [(10,), (20,), (50,), (None,)]


def test_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [0.5, None, None]


def test_percentages_round_differently(spark):
    row = spark.range(1).select(
        decimal_share_pct(F.lit(74), F.lit(231)).alias("d"), double_share_pct(F.lit(74), F.lit(231)).alias("f")
    ).first()
    assert (float(row["d"]), row["f"]) == (32.04, 32.03)


def test_json_object(spark):
    df = spark.createDataFrame([('{"5812": "Eating, Places", "5541": "Fuel"}',), (None,), ("{}",)], "value string")
    rows = {tuple(r) for r in json_object_to_rows(df, "value", "mcc", "label").collect()}
    assert rows == {(5812, "Eating, Places"), (5541, "Fuel")}
    for broken in ('{"58x": "Eating"}', '{"5812": '):
        bad = spark.createDataFrame([(broken,)], "value string")
        with pytest.raises((PySparkException, Py4JJavaError)):
            json_object_to_rows(bad, "value", "mcc", "label").collect()


def test_null_map_gives_no_rows(spark):
    df = spark.sql("SELECT CAST(NULL AS map<string,string>) AS m")
    assert explode_map(df, F.col("m"), "k", "v").count() == 0
