"""Column names, types and feature lists of the customer table.

Columns are snake_case inside the library; ``SOURCE_NAMES`` maps the names found
in files (with spaces) at the edges.
"""

from __future__ import annotations

from pyspark.sql import types as T

# File column name -> (internal name, type), in file order.
CUSTOMER_FIELDS = [
    ("State", "state", T.StringType()),
    ("Account length", "account_length", T.IntegerType()),
    ("Area code", "area_code", T.IntegerType()),
    ("International plan", "intl_plan", T.StringType()),
    ("Voice mail plan", "vmail_plan", T.StringType()),
    ("Number vmail messages", "vmail_messages", T.IntegerType()),
    ("Total day minutes", "day_minutes", T.DoubleType()),
    ("Total day calls", "day_calls", T.IntegerType()),
    ("Total day charge", "day_charge", T.DoubleType()),
    ("Total eve minutes", "eve_minutes", T.DoubleType()),
    ("Total eve calls", "eve_calls", T.IntegerType()),
    ("Total eve charge", "eve_charge", T.DoubleType()),
    ("Total night minutes", "night_minutes", T.DoubleType()),
    ("Total night calls", "night_calls", T.IntegerType()),
    ("Total night charge", "night_charge", T.DoubleType()),
    ("Total intl minutes", "intl_minutes", T.DoubleType()),
    ("Total intl calls", "intl_calls", T.IntegerType()),
    ("Total intl charge", "intl_charge", T.DoubleType()),
    ("Customer service calls", "cs_calls", T.IntegerType()),
]

SOURCE_NAMES = {source: name for source, name, _ in CUSTOMER_FIELDS} | {"Churn": "churn"}
FILE_NAMES = {name: source for source, name in SOURCE_NAMES.items()}
FEATURES = [name for _, name, _ in CUSTOMER_FIELDS]

PERIODS = ["day", "eve", "night", "intl"]
CATEGORICAL = ["state", "area_code", "intl_plan", "vmail_plan", "cs_calls", "churn"]
COUNTABLE = [name for name in FEATURES if name not in CATEGORICAL]

# The thirteen measures checked for normality and cleaned of outliers.
MEASURES = ["account_length"] + [
    f"{period}_{kind}" for period in PERIODS for kind in ("minutes", "calls", "charge")
]

# Columns dropped as correlated once totals are derived.
CORRELATED = [f"{period}_minutes" for period in PERIODS] + ["vmail_plan"]

# Columns of the correlation matrix before and after the correlated ones go.
CORRELATION_BEFORE = [
    "account_length", "day_minutes", "vmail_flag", "vmail_messages", "day_calls", "day_charge",
    "eve_minutes", "eve_calls", "eve_charge", "night_minutes", "night_calls", "night_charge",
    "intl_minutes", "intl_calls", "intl_charge",
]
CORRELATION_AFTER = [
    "account_length", "vmail_messages", "day_calls", "day_charge", "eve_calls", "eve_charge",
    "night_calls", "night_charge", "intl_calls", "intl_charge",
    "total_calls", "total_charge", "cs_rate",
]


def file_schema(with_label: bool = True, with_id: bool = False) -> T.StructType:
    """Schema of customer files, under their file column names."""
    fields = [T.StructField(source, kind) for source, _, kind in CUSTOMER_FIELDS]
    if with_label:
        fields.append(T.StructField("Churn", T.BooleanType()))
    if with_id:
        fields.insert(0, T.StructField("customer_id", T.LongType()))
    return T.StructType(fields)


EVENT_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("project_name", T.StringType()),
    T.StructField("hostname", T.StringType()),
    T.StructField("logger_name", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment_name", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("param_name", T.StringType()),
    T.StructField("param_value", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
])

# The stored log has the day as its partition column.
LOG_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("log_date", T.StringType())])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("churn_prediction", T.IntegerType()),
    T.StructField("churn_probability", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("risk_level", T.StringType()),
])

VERSION_SCHEMA = T.StructType([
    T.StructField("version_history", T.ArrayType(T.StructType([
        T.StructField("version", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]))),
    T.StructField("version", T.StringType()),
    T.StructField("last_trained", T.TimestampType()),
    T.StructField("version_scores", T.MapType(T.StringType(), T.StructType([
        T.StructField("scores", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("evaluation_date", T.TimestampType()),
    ]))),
])
