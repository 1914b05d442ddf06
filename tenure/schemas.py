"""Column contracts of the bronze, silver and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tenure.errors import DataQualityError

CUSTOMER_COLUMNS = ("customer_id", "signup_date", "country")
SUBSCRIPTION_COLUMNS = ("customer_id", "start_date", "end_date", "plan", "monthly_price")

# Sums of 10**10 such prices still fit into 38 digits.
PRICE = T.DecimalType(28, 6)

SILVER_CUSTOMERS = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("country", T.StringType()),
    ]
)

SILVER_SUBSCRIPTIONS = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("end_date_raw", T.StringType()),
        T.StructField("end_date_malformed", T.BooleanType()),
        T.StructField("plan", T.StringType()),
        T.StructField("monthly_price", PRICE),
    ]
)

def require_columns(df: DataFrame, columns: tuple[str, ...], table: str) -> None:
    """Raise when ``df`` lacks one of ``columns``; extra columns are tolerated."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise DataQualityError(f"Missing required columns in {table}: {missing}")


def require_types(df: DataFrame, schema: T.StructType, table: str) -> None:
    """Raise when a column named in ``schema`` is absent or has another type."""
    require_columns(df, tuple(schema.fieldNames()), table)
    wrong = {
        f.name: df.schema[f.name].dataType.simpleString()
        for f in schema.fields
        if df.schema[f.name].dataType != f.dataType
    }
    if wrong:
        raise DataQualityError(f"Unexpected column types in {table}: {wrong}")
