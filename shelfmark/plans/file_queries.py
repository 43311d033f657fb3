"""Registered queries of the file readers and sinks: each writes rows of a driver table, reads them back by the library, and stands beside SQL on the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.plans.fixtures import Tables
from shelfmark.plans.queries import query
from shelfmark.session import shared_folder
from shelfmark.sources import readers


def _place(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/files-{uuid.uuid4().hex}"


def _named_files(rows: DataFrame, place: str, ending: str) -> str:
    """A text file ``<name><ending>`` for each name of ``rows`` (name, value), beside each other; the folder."""
    readers.write_named_files(rows, f"{place}/named", ending)
    return f"{place}/named"


@query("""SELECT CASE WHEN s_suppkey % 4 > 0 THEN 's' || s_suppkey || '.PDF' END AS name, length(s_name || s_nationkey) + 1 AS size, 'disk' AS source, 2 AS priority FROM supplier WHERE s_suppkey % 4 > 0""")
def a2_scan_files(t):
    s = t.supplier
    folder = _named_files(s.select(F.when(s.s_suppkey % 4 > 0, F.concat(F.lit("s"), "s_suppkey")).otherwise(F.translate(s.s_suppkey.cast("string"), "0123456789", "abcdefghij")).alias("name"), F.concat("s_name", "s_nationkey").alias("value")), _place(t), ".PDF")
    return readers.scan_files(t.spark, folder, "disk", 2).select(F.substring_index("path", "/", -1).alias("name"), "size", "source", "priority")


_LINES = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])


def _lines(t: Tables) -> str:
    place, c = _place(t), t.customer
    whole = F.to_json(F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")))
    c.select(F.when(c.c_custkey % 7 == 0, F.concat(F.lit('{"k": '), "c_custkey", F.lit(', "name": "cut'))).otherwise(whole).alias("value")).write.text(place)
    return place


@query("""SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey % 7 <> 0""")
def a3_read_jsonl(t):
    return readers.read_jsonl(t.spark, _lines(t), _LINES)


@query("""SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 7 = 0 THEN '{"k": ' || c_custkey || ', "name": "cut' END AS bad FROM customer""")
def a3_read_jsonl_kept(t):
    return readers.read_jsonl(t.spark, _lines(t), _LINES, "keep").select("name", F.col("_corrupt").alias("bad"))


@query("""SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders""")
def a4_a10_reports(t):
    place, o = _place(t), t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    parts = []
    for n, (fmt, sep) in enumerate((("csv", ","), ("tsv", "\t"), ("json", ""))):
        path, schema = f"{place}/{fmt}", o.select(columns).schema
        readers.write_report(o.where(F.col("o_orderkey") % 3 == n), path, columns, fmt)
        parts.append(readers.read_jsonl(t.spark, path, schema) if fmt == "json" else readers.read_delimited(t.spark, path, schema, sep))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT 'p' || s_suppkey AS doc_id, 'p' || s_suppkey || '_v' || s_nationkey AS stem, s_name || chr(10) AS text FROM supplier""")
def a5_read_documents(t):
    folder = _named_files(t.supplier.select(F.concat(F.lit("p"), "s_suppkey", F.lit("_v"), "s_nationkey").alias("name"), F.col("s_name").alias("value")), _place(t), ".txt")
    return readers.read_documents(t.spark, f"{folder}/*.txt")


@query("""SELECT o_orderkey AS k, 'Lab ' || left(o_orderpriority, 1) AS org, CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE o_orderkey % 11 <> 0""")
def a6_org_year_shards(t):
    o = t.orders
    name = F.concat(F.lit("Lab_"), F.left("o_orderpriority", F.lit(1)), F.lit("__"), F.year("o_orderdate"))
    rows = o.select(F.when(o.o_orderkey % 11 == 0, "notes").otherwise(name).alias("name"), F.to_json(F.struct(F.col("o_orderkey").alias("k"))).alias("value"))
    folder = _named_files(rows, _place(t), ".jsonl")
    return readers.read_org_year_shards(t.spark, f"{folder}/*", T.StructType([T.StructField("k", T.LongType())]))


@query("""SELECT 's' || s_suppkey || '.bin' AS name, octet_length(encode('%PDF-' || s_name)) + 1 AS size, '25504446' AS magic, sha256('%PDF-' || s_name || chr(10)) AS sha256 FROM supplier""")
def a8_read_payloads(t):
    folder = _named_files(t.supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("name"), F.concat(F.lit("%PDF-"), "s_name").alias("value")), _place(t), ".bin")
    return readers.read_payloads(t.spark, f"{folder}/*.bin").select(F.substring_index("path", "/", -1).alias("name"), "size", "magic", "sha256")


@query("""SELECT attempt_id, record_id FROM attempts UNION ALL SELECT attempt_id, record_id FROM attempts WHERE attempt_id % 2 = 0""")
def a9_append_results(t):
    place, rows = _place(t), t.attempts.select("attempt_id", "record_id")
    readers.append_results(rows, place)
    readers.append_results(rows.where("attempt_id % 2 = 0"), place)
    return t.spark.read.schema(rows.schema).parquet(place)
