"""Customer files and record lists: scans with a fixed schema, validation, sinks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from keeprate.schema import CUSTOMER_FIELDS, FILE_NAMES, SOURCE_NAMES, file_schema


def to_internal(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in SOURCE_NAMES.items() if a in df.columns})


def to_external(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in FILE_NAMES.items() if a in df.columns})


CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema with a column that takes the text of records that cannot be parsed."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_customers_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, corrupt: bool = False) -> DataFrame:
    """Customer CSV with header; types are given, so train and score files agree.

    ``corrupt`` adds ``_corrupt_record``: the text of a malformed record, null for the others.
    """
    schema = schema or file_schema()
    schema = with_corrupt(schema) if corrupt else schema
    return to_internal(spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def read_customers_json(spark: SparkSession, path: str, schema: T.StructType | None = None, corrupt: bool = False) -> DataFrame:
    """Customer records, one JSON object per line, under their file names; ``corrupt`` as for CSV."""
    schema = schema or file_schema(with_label=False)
    schema = with_corrupt(schema) if corrupt else schema
    return to_internal(spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path))


def customers_from_records(spark: SparkSession, records: list[dict]) -> DataFrame:
    """A short list of records already on the driver, under file or internal names."""
    schema = file_schema(with_label=False)
    rows = [tuple(r.get(f.name, r.get(SOURCE_NAMES[f.name])) for f in schema.fields) for r in records]
    return to_internal(spark.createDataFrame(rows, schema))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("overwrite").csv(path)


def template(spark: SparkSession) -> DataFrame:
    """An empty customer table under file names, for writing a header-only template."""
    return spark.createDataFrame([], file_schema(with_label=False))


def validate(raw: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) from a table of text columns under file names.

    A record is rejected when a required field is missing or not of its type; the
    rejected rows keep their raw text and list the fields at fault.
    """
    keep = keep or []

    def typed(source: str, kind: T.DataType) -> Column:
        value = F.col(f"`{source}`")
        return value if isinstance(kind, T.StringType) else F.trim(value).try_cast(kind)

    faults = F.filter(
        F.array(*[
            F.when(typed(source, kind).isNull(), F.lit(source)) for source, _, kind in CUSTOMER_FIELDS
        ]),
        lambda name: name.isNotNull(),
    )
    bad = reduce(or_, [typed(source, kind).isNull() for source, _, kind in CUSTOMER_FIELDS])
    accepted = raw.filter(~bad).select(
        *keep, *[typed(source, kind).alias(name) for source, name, kind in CUSTOMER_FIELDS]
    )
    return accepted, raw.filter(bad).withColumn("faults", faults)
