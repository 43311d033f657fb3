"""Merges, upserts and audited changes: tables in, tables out; a second run changes nothing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str, fill: list[str], replace: list[str], keep: list[str]) -> DataFrame:
    """``fill``: the new value unless null; ``replace``: the new row's value; ``keep``: the old value if there is a row.

    ``new`` holds one row a key at most (``insert_replace`` makes it so). ``change`` is added, updated or kept.
    """
    a = old.select(key, *[F.col(c).alias(f"o_{c}") for c in (*fill, *replace, *keep)], F.lit(True).alias("_o"))
    b = new.select(key, *[F.col(c).alias(f"n_{c}") for c in (*fill, *replace, *keep)], F.lit(True).alias("_n"))
    j = a.join(b, key, "full")
    there = F.col("_n").isNotNull()
    return j.select(
        key,
        *[F.coalesce(f"n_{c}", f"o_{c}").alias(c) for c in fill],
        *[F.when(there, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) for c in replace],
        *[F.when(F.col("_o").isNotNull(), F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c) for c in keep],
        F.when(F.col("_o").isNull(), "added").when(there, "updated").otherwise("kept").alias("change"),
    )


def insert_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """First writer wins, within ``new`` by order of its columns."""
    fresh = insert_replace(new, [key], [F.col(c).desc() for c in new.columns if c != key] or [F.col(key)])
    return old.unionByName(fresh.join(old.select(key), key, "left_anti").select(*old.columns))


def insert_replace(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in the given order."""
    last = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")


def exclude_records(records: DataFrame, condition: Column, run_tag: str, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records left, one decision for each record removed, with its row as it was)."""
    hit = F.coalesce(condition, F.lit(False))
    decisions = records.where(hit).select("record_id", F.lit("exclude").alias("action"), F.lit(run_tag).alias("run_tag"), F.to_json(F.struct(*records.columns)).alias("before"))
    return (records if dry_run else records.where(~hit)), decisions


def exclusion_run(decisions: DataFrame, run_tag: str, started: datetime, ended: datetime) -> DataFrame:
    """The run row of an exclusion: its tag, its times and how many records it removed."""
    n = decisions.where(F.col("run_tag") == run_tag).agg(F.count("*").alias("updated"))
    return n.select(
        F.lit("exclusion_pass").alias("run_type"), F.create_map(F.lit("run_tag"), F.lit(run_tag)).alias("params"), F.lit(started).alias("started"), F.lit(ended).alias("ended"),
        F.lit(0).cast("long").alias("added"), "updated", F.lit(0).cast("long").alias("errors"),
    )


def reconcile_orphans(files: DataFrame, scan: DataFrame) -> DataFrame:
    """Scanned paths that no file row has."""
    return scan.join(files.select("path"), "path", "left_anti")


def promote(records: DataFrame, resolved: DataFrame) -> DataFrame:
    """Fill org_code and year only where empty; ``year_set`` and ``year_differs`` say what the lookup would change."""
    r = resolved.select("record_id", F.col("org_code").alias("n_org"), F.col("year").alias("n_year"))
    j = records.join(r, "record_id", "left")
    empty = F.coalesce(F.col("org_code"), F.lit("")).isin("", "UNKNOWN")
    return j.select(
        *[c for c in records.columns if c not in ("org_code", "year")],
        F.when(empty, F.coalesce("n_org", "org_code")).otherwise(F.col("org_code")).alias("org_code"), F.coalesce("year", "n_year").alias("year"),
        (F.col("year").isNull() & F.col("n_year").isNotNull()).alias("year_set"), F.coalesce(F.col("year") != F.col("n_year"), F.lit(False)).alias("year_differs"),
    )


def apply_lookup(records: DataFrame, lookups: DataFrame) -> DataFrame:
    n = lookups.select("record_id", F.col("doi").alias("n_doi"), "status")
    doi = F.when(F.coalesce(F.col("doi"), F.lit("")) == "", F.coalesce("n_doi", "doi")).otherwise(F.col("doi"))
    return records.join(n, "record_id", "left").withColumn("doi", doi).drop("n_doi")


def set_sidecar(records: DataFrame, sidecars: DataFrame) -> DataFrame:
    n = sidecars.select("record_id", F.col("md_path").alias("n_path"))
    return records.join(n, "record_id", "left").withColumn("md_path", F.coalesce(F.nullif("md_path", F.lit("")), "n_path")).drop("n_path")


def assign_canonical_path(files: DataFrame, records: DataFrame) -> DataFrame:
    """``year/record_id.pdf`` by the record's year, else the path's, else ``unknown``."""
    j = files.join(records.select("record_id", F.col("year").alias("r_year")), "record_id", "left")
    folder = F.coalesce(F.col("r_year").cast("string"), F.col("path_year").cast("string"), F.lit("unknown"))
    return j.withColumn("canonical_path", F.concat(folder, F.lit("/"), "record_id", F.lit(".pdf"))).drop("r_year")


def repair_canonical_path(files: DataFrame, listing: DataFrame) -> DataFrame:
    """``files`` with paths that the listing has: an assigned path that isn't there gives way to a listed one of the same name (the first by text), if any.

    ``repair`` is ``in_place``, ``moved`` or ``missing``.
    """
    here = listing.select(F.col("path").alias("canonical_path"), F.lit(True).alias("_here")).distinct()
    named = listing.groupBy(F.substring_index("path", "/", -1).alias("_name")).agg(F.min("path").alias("_other"))
    j = files.join(here, "canonical_path", "left").withColumn("_name", F.substring_index("canonical_path", "/", -1)).join(named, "_name", "left")
    repair = F.when(F.col("_here"), "in_place").when(F.col("_other").isNotNull(), "moved").otherwise("missing")
    path = F.when(repair == "moved", F.col("_other")).otherwise(F.col("canonical_path"))
    return j.select(*[path.alias(c) if c == "canonical_path" else F.col(c) for c in files.columns], repair.alias("repair"))


def plan_layout(files: DataFrame, listing: DataFrame) -> DataFrame:
    """What laying a file out would do; nothing is linked."""
    here = listing.select(F.col("path"), F.lit(True).alias("has_source"))
    there = listing.select(F.col("path").alias("canonical_path"), F.col("size").alias("there_size"))
    j = files.join(here, "path", "left").join(there, "canonical_path", "left")
    outcome = (
        F.when(F.startswith("canonical_path", F.lit("unknown/")), "no_year").when(F.col("path") == F.col("canonical_path"), "skipped_in_layout")
        .when(F.col("has_source").isNull(), "src_missing").when(F.col("there_size") == F.col("size"), "already_linked")
        .when(F.col("there_size").isNotNull(), "conflict").otherwise("linked")
    )
    return j.select(*files.columns, outcome.alias("outcome"))


def write_back_year(inventory: DataFrame, lookup: DataFrame) -> DataFrame:
    j = inventory.join(lookup.select("record_id", F.col("year").alias("n_year")), "record_id", "left")
    return j.withColumn("bucket", F.coalesce("bucket", F.when(F.col("n_year").isNotNull(), "lookup"))).withColumn("year", F.coalesce("year", "n_year")).drop("n_year")


def run_record(spark: SparkSession, run_type: str, params: dict[str, str], counts: dict[str, int], started: datetime, ended: datetime, notes: str = "") -> DataFrame:
    row = (run_type, params, started, ended, counts.get("added", 0), counts.get("updated", 0), counts.get("errors", 0), notes)
    return spark.createDataFrame([row], "run_type string, params map<string,string>, started timestamp, ended timestamp, added long, updated long, errors long, notes string")


def merge_counts(merged: DataFrame, run_type: str, params: dict[str, str]) -> DataFrame:
    """A run row's type, params, added and updated, counted from the ``change`` of an upsert; the caller adds times and notes."""
    given = F.create_map(*[F.lit(x) for pair in params.items() for x in pair]).alias("params")
    n = merged.agg(F.count_if(F.col("change") == "added").alias("added"), F.count_if(F.col("change") == "updated").alias("updated"))
    return n.select(F.lit(run_type).alias("run_type"), given, "added", "updated", F.lit(0).cast("long").alias("errors"))


def undecided(ids: DataFrame, decisions: DataFrame, run_tag: str) -> DataFrame:
    return ids.join(decisions.where(F.col("run_tag") == run_tag).select("record_id"), "record_id", "left_anti")
