"""Static lookup dimensions (seeds): vendors, rate codes, payment types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from meterline.functions.joins import literal_frame
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The three lookup tables of the reference, in their order.
# The vendor 2 description keeps its two trailing spaces.
VENDOR_ROWS = [
    (1, "Creative Mobile Technologies LLC", "TPEP provider - Creative Mobile Technologies"),
    (2, "Curb Mobility LLC", "TPEP provider - Curb Mobility  "),
    (6, "Myle Technologies Inc", "TPEP provider - Myle Technologies"),
    (7, "Helix", "TPEP provider - Helix"),
]
RATE_CODE_ROWS = [
    (1, "Standard rate", "Standard taxi rate"),
    (2, "JFK", "JFK Airport rate"),
    (3, "Newark", "Newark Airport rate"),
    (4, "Nassau or Westchester", "Nassau or Westchester rate"),
    (5, "Negotiated fare", "Negotiated fare rate"),
    (6, "Group ride", "Group ride rate"),
    (99, "Null/unknown", "Null or unknown rate code"),
]
PAYMENT_TYPE_ROWS = [
    (0, "Flex Fare trip", "Flex Fare trip payment"),
    (1, "Credit card", "Credit card payment"),
    (2, "Cash", "Cash payment"),
    (3, "No charge", "No charge payment"),
    (4, "Dispute", "Dispute payment"),
    (5, "Unknown", "Unknown payment type"),
    (6, "Voided trip", "Voided trip payment"),
]


def _schema(key: str, name: str, desc: str) -> StructType:
    return StructType([
        StructField(key, IntegerType(), False),
        StructField(name, StringType(), True),
        StructField(desc, StringType(), True),
    ])


SEEDS = {
    "dim_vendor": (_schema("vendor_id", "vendor_name", "vendor_description"), VENDOR_ROWS),
    "dim_rate_code": (_schema("rate_code_id", "rate_code_name", "rate_code_description"), RATE_CODE_ROWS),
    "dim_payment_type": (_schema("payment_type", "payment_name", "payment_description"), PAYMENT_TYPE_ROWS),
}


def seed(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = SEEDS[name]
    return literal_frame(spark, rows, schema)


def dim_vendor(spark: SparkSession) -> DataFrame:
    return seed(spark, "dim_vendor")


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return seed(spark, "dim_rate_code")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return seed(spark, "dim_payment_type")


def load_seed_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read a seed CSV with the seed's declared schema (no inference)."""
    schema, _ = SEEDS[name]
    return spark.read.option("header", True).schema(schema).csv(path)
