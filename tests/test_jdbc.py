"""The texts and options sent to a database, checked without one.

The SQL is run by Spark on a view, the part conditions on a DataFrame. Nothing here connects.
"""

import pytest

from swipelake.sources import jdbc


@pytest.fixture
def table(spark):
    rows = [(k,) for k in [*range(1, 2001), 10**12, 10**12 + 1, None]]
    spark.createDataFrame(rows, "id bigint").createOrReplaceTempView("source_tx")
    return "source_tx"


def test_bounds_and_counts(spark, table):
    assert jdbc.key_bounds(spark.sql, table, "id") == (1, 10**12 + 1)
    assert jdbc.rows_in(spark.sql, table) == 2003
    assert jdbc.rows_in(spark.sql, "no_such_table") == 0
    spark.createDataFrame([], "id bigint").createOrReplaceTempView("empty_tx")
    assert jdbc.key_bounds(spark.sql, "empty_tx", "id") is None
    assert jdbc.range_counts(spark.sql, table, "id")(1, 500, 4) == {0: 500, 1: 500, 2: 500, 3: 500}


def test_parts_take_every_row_once_and_share_the_load(spark, table):
    cuts = jdbc.equal_load_cuts(jdbc.range_counts(spark.sql, table, "id"), 1, 10**12 + 1, 8)
    parts = jdbc.range_predicates("id", cuts)
    assert len(parts) == 8
    df = spark.table(table)
    loads = [df.where(p).count() for p in parts]
    assert sum(loads) == 2003 and max(loads) <= 2003 / 8 * 1.1 + 2
    late = spark.createDataFrame([(-5,), (10**13,)], "id bigint")  # arrived after counting
    assert sum(late.where(p).count() for p in parts) == 2


def test_no_cuts_is_one_part(spark, table):
    assert jdbc.range_predicates("id", []) == ["1 = 1"]
    assert spark.table(table).where("1 = 1").count() == 2003


def test_read_options():
    assert jdbc.stride_options("id", None, 8, 10_000) == {"fetchsize": "10000"}
    assert jdbc.stride_options("id", (3, 90), 8, 10_000) == {
        "fetchsize": "10000",
        "partitionColumn": "id",
        "lowerBound": "3",
        "upperBound": "90",
        "numPartitions": "8",
    }
    assert jdbc.derived_table("SELECT 1") == "(SELECT 1) q"


def test_write_options():
    options = jdbc.write_options(truncate=True, batch=2000, connections=4, column_types="id BIGINT")
    assert options == {
        "truncate": "true", "batchsize": "2000", "numPartitions": "4", "createTableColumnTypes": "id BIGINT"
    }


def test_database_from_environment(monkeypatch):
    monkeypatch.setenv("MART_URL", "jdbc:postgresql://db/mart")
    monkeypatch.setenv("MART_USER", "u")
    monkeypatch.delenv("MART_PASSWORD", raising=False)
    assert jdbc.Database.from_env("MART").options() == {"url": "jdbc:postgresql://db/mart", "user": "u"}


def test_created_table_has_all_columns_and_its_default():
    from swipelake import schemas

    text = jdbc.create_statement("transactions", schemas.SOURCE_TABLE_COLUMNS)
    assert text.startswith("CREATE TABLE IF NOT EXISTS transactions (id BIGINT, date DATE, ") and "errors TEXT" in text
    assert text.endswith("situation_date DATE NOT NULL DEFAULT (CURRENT_DATE))")
    file_columns = [f.name for f in schemas.TRANSACTION_FILE.fields]
    assert list(schemas.SOURCE_TABLE_COLUMNS) == [*file_columns, "situation_date"]
