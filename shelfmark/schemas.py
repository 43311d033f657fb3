"""Schemas of the catalog tables, and additive schema changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"long": T.LongType(), "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (x.split() for x in text.split(", "))])


FILES = _schema("instance_id long, record_id string, source string, path string, size long, sha256 string, title_score double")
ATTEMPTS = _schema("attempt_id long, record_id string, ts timestamp, source string, http_status int, bytes long, saved_path string, error string")
RECORDS = _schema("record_id string, doi string, title string, publication_date string, year int, product_type string, org_code string, has_file boolean, canonical_path string, md_path string")


def ensure_columns(df: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the schema's missing columns as typed nulls; a missing required column is an error."""
    if lost := [c for c in required if c not in df.columns]:
        raise ValueError(f"required columns are missing: {', '.join(lost)}")
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns})
