"""Schemas of the raw inputs.

Files do not enforce "not null"; the quality gate does.
"""

from pyspark.sql import types as T

# Column names, types and order of the raw inputs.
TRANSACTIONS = (
    T.StructType()
    .add("transaction_id", T.IntegerType(), False)
    .add("customer_id", T.IntegerType(), False)
    .add("product_name", T.StringType(), False)
    .add("transaction_date", T.DateType(), False)
)
CUSTOMERS = (
    T.StructType()
    .add("customer_id", T.IntegerType(), False)
    .add("customer_name", T.StringType(), False)
    .add("join_date", T.DateType(), False)
    .add("location", T.StringType(), False)
)
RAW_PRODUCTS = (
    T.StructType()
    .add("product_id", T.IntegerType(), False)
    .add("product_name", T.StringType(), False)
    .add("category", T.StringType(), False)
    .add("price", T.DoubleType(), False)
)


def with_wide_ids(schema: T.StructType) -> T.StructType:
    """The same schema with bigint ids, for more rows than an int can number."""
    return T.StructType(
        [
            T.StructField(f.name, T.LongType(), f.nullable)
            if isinstance(f.dataType, T.IntegerType)
            else f
            for f in schema
        ]
    )
