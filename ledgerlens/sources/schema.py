"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The column and feature names of the data.
V_COLUMNS = [f"v{i}" for i in range(1, 29)]

RAW_SCHEMA = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(f"V{i}", T.DoubleType()) for i in range(1, 29)]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())]
)

CLEANED_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("time_seconds", T.DoubleType())]
    + [T.StructField(v, T.DoubleType()) for v in V_COLUMNS]
    + [T.StructField("amount_scaled", T.DoubleType()), T.StructField("class", T.IntegerType())]
)

TRANSACTION_COLUMNS = ["id", "time_seconds", *V_COLUMNS, "amount", "class"]

DERIVED_FEATURES = [
    "hour_of_day",
    "high_risk_hour",
    "amount_zscore",
    "high_value_flag",
    "v1_v3_interact",
    "v4_v11_interact",
]

# The 35 model inputs, in table order.
FEATURES = [*V_COLUMNS, "amount_scaled", *DERIVED_FEATURES]

FEATURED_COLUMNS = ["id", *V_COLUMNS, "amount_scaled", "class", *DERIVED_FEATURES]
