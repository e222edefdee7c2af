"""Declared schemas, so that no file is read a second time only to guess its types."""

from pyspark.sql import types as T

# Column names and types of the inputs and of the relational tables.

# the transactions file; its date may carry a time of day, and its amount is money as text
TRANSACTION_FILE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("client_id", T.IntegerType()),
        T.StructField("card_id", T.IntegerType()),
        T.StructField("amount", T.StringType()),
        T.StructField("use_chip", T.StringType()),
        T.StructField("merchant_id", T.IntegerType()),
        T.StructField("merchant_city", T.StringType()),
        T.StructField("merchant_state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("mcc", T.IntegerType()),
        T.StructField("errors", T.StringType()),
    ]
)

USERS_FILE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("current_age", T.IntegerType()),
        T.StructField("retirement_age", T.IntegerType()),
        T.StructField("birth_year", T.IntegerType()),
        T.StructField("birth_month", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("per_capita_income", T.StringType()),
        T.StructField("yearly_income", T.StringType()),
        T.StructField("total_debt", T.StringType()),
        T.StructField("credit_score", T.IntegerType()),
        T.StructField("num_credit_cards", T.IntegerType()),
    ]
)

FRAUD_LABELS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("target", T.StringType())]
)

# The same with the text of a row that cannot be read.
RAW_FRAUD_LABELS = T.StructType([*FRAUD_LABELS.fields, T.StructField("_corrupt_record", T.StringType())])

# whole numbers among the columns of the cards file; all others, card numbers too, are text there
CARD_NUMBERS = ("id", "client_id", "num_cards_issued", "year_pin_last_changed")

# one JSON object whose fields are the data: code -> text
JSON_DICTIONARY = T.MapType(T.StringType(), T.StringType())

# columns of the relational source table when it has to be created
SOURCE_TABLE_COLUMNS = {
    "id": "BIGINT",
    "date": "DATE",
    "client_id": "INT",
    "card_id": "INT",
    "amount": "VARCHAR(25)",
    "use_chip": "VARCHAR(255)",
    "merchant_id": "INT",
    "merchant_city": "VARCHAR(255)",
    "merchant_state": "VARCHAR(255)",
    "zip": "VARCHAR(10)",
    "mcc": "INT",
    "errors": "TEXT",
    "situation_date": "DATE NOT NULL DEFAULT (CURRENT_DATE)",
}

# columns of the API responses
TRANSACTION_VIEW = ["id", "date", "client_id", "amount", "merchant_city"]
CLIENT_VIEW = ["id", "gender", "age", "retirement_age", "address", "credit_score"]
