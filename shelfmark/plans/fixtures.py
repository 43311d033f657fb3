"""Catalog tables built from the driver tables: one list of expressions serves Spark and SQL, so they can't drift."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import ship

RECORDS = {
    "record_id": "CAST(doc_id AS STRING)",
    "doc_id": "doc_id",
    "doi": "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE concat('10.', CAST(1000 + doc_id % 50 AS STRING), '/x', CAST(doc_id AS STRING)) END",
    "title": "substr(text, 1, 60)",
    "year": "CAST(2000 + doc_id % 27 AS INT)",
    "org_code": "source",
    "product_type": "CASE doc_id % 7 WHEN 0 THEN 'Journal Article' WHEN 1 THEN 'Conference' WHEN 2 THEN 'Dataset' WHEN 3 THEN 'Thesis' WHEN 4 THEN NULL WHEN 5 THEN 'Software' ELSE 'Technical Report' END",
    "publication_date": "CASE doc_id % 6 WHEN 0 THEN concat(CAST(2000 + doc_id % 27 AS STRING), '-04-15T00:00:00Z') WHEN 1 THEN concat('04/15/', CAST(2000 + doc_id % 27 AS STRING)) WHEN 2 THEN CAST(1990 + doc_id % 27 AS STRING) WHEN 3 THEN NULL WHEN 4 THEN 'n.d.' ELSE '2020-1' END",
    "has_file": "doc_id % 4 = 0",
    "canonical_path": "CASE WHEN doc_id % 6 = 0 THEN concat('/c/', CAST(doc_id % 300 AS STRING), '.pdf') END",
    "md_path": "CASE WHEN doc_id % 3 = 0 THEN concat('/md/', CAST(doc_id AS STRING), '.md') WHEN doc_id % 3 = 1 THEN '' END",
    "size": "n_chars",
}
FILES = {
    "instance_id": "doc_id",
    "record_id": "CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING)",
    "source": "CASE CAST(doc_id * 7 % 3 AS INT) WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END",
    "priority": "CAST(doc_id * 7 % 3 AS INT) + 1",
    "path": "concat('/data/', CASE WHEN doc_id % 4 = 0 THEN 'misc' ELSE CAST(2010 + doc_id % 12 AS STRING) END, '/', CAST(doc_id % 350 AS STRING), '.pdf')",
    "path_year": "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(2010 + doc_id % 12 AS INT) END",
    "size": "CASE WHEN doc_id % 11 = 0 THEN 0 ELSE n_chars END",
    "sha256": "CASE WHEN doc_id % 13 = 0 THEN NULL WHEN floor(doc_id / 3) % 4 = 0 THEN md5(CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING)) ELSE md5(text) END",
    "title_score": "CASE WHEN doc_id % 9 = 0 THEN CAST(0.95 AS DOUBLE) WHEN doc_id % 9 = 4 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE) END",
}
_STATUS = "CASE event_id % 6 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 WHEN 3 THEN 503 WHEN 4 THEN 0 ELSE 200 END"
_BYTES = "CAST(floor(abs(value) * 100) AS BIGINT)"
_SAVED = "CASE WHEN event_id % 6 = 0 THEN concat('/s/', CAST(event_id AS STRING)) END"
_BUCKET = f"CASE WHEN event_id % 6 = 1 THEN 'not_found' WHEN event_id % 6 = 2 THEN 'forbidden' WHEN event_id % 6 = 3 THEN 'unavailable' WHEN event_id % 6 IN (0, 5) AND {_BYTES} <= 1024 THEN 'empty' WHEN event_id % 6 = 5 THEN 'wrong_type_or_redirect' WHEN event_id % 6 = 4 THEN 'timeout_or_exception' ELSE 'other' END"
ATTEMPTS = {
    "attempt_id": "event_id",
    "record_id": "CAST(user_id AS STRING)",
    "ts": "ts",
    "source": "event_type",
    "http_status": _STATUS,
    "bytes": _BYTES,
    "saved_path": _SAVED,
    "error": "CASE event_id % 3 WHEN 0 THEN 'TimeoutError: timed out' WHEN 1 THEN 'URLError: connection reset' ELSE 'SSLError: bad certificate' END",
}

def _select(columns: dict[str, str], table: str) -> str:
    return f"SELECT {', '.join(f'{v} AS {k}' for k, v in columns.items())} FROM {table}"


#: The same tables as SQL, to put before a query.
SQL = (
    f"WITH records AS ({_select(RECORDS, 'documents')}), files AS ({_select(FILES, 'documents')}),\n"
    f"attempts AS ({_select(ATTEMPTS, 'events')}), bucketed AS (SELECT *, {_BUCKET.replace('event_id', 'attempt_id').replace(_BYTES, 'bytes')} AS bucket FROM attempts)"
)


class Tables:
    """The driver tables and the catalog tables made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = ship(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def records(self) -> DataFrame:
        return self.documents.selectExpr(*[f"{v} AS {k}" for k, v in RECORDS.items()])

    @cached_property
    def files(self) -> DataFrame:
        return self.documents.selectExpr(*[f"{v} AS {k}" for k, v in FILES.items()])

    @cached_property
    def attempts(self) -> DataFrame:
        return self.events.selectExpr(*[f"{v} AS {k}" for k, v in ATTEMPTS.items()])

    @cached_property
    def bucketed(self) -> DataFrame:
        from shelfmark.functions.outcomes import bucket_attempt

        a = self.attempts
        return a.withColumn("bucket", bucket_attempt(a.http_status, a.bytes, a.saved_path))
