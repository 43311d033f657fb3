"""Attempt streams: health, breaker, resume, queue maintenance and progress, with their batch twins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfmark.operators.kept import KeptRuns, union

LATE = "10 minutes"


def health(attempts: DataFrame, most: int = 50, span: str = "5 minutes", step: str = "1 minute") -> DataFrame:
    """Failures of each source in a sliding window; the same plan serves a stream (with a watermark) and a batch."""
    rows = attempts.withWatermark("ts", LATE) if attempts.isStreaming else attempts
    n = rows.groupBy(F.window("ts", span, step), "source").agg(F.count_if(F.expr("http_status <> 200")).alias("failures"), F.count("*").alias("n"))
    return n.select(F.col("window.start").alias("start"), "source", "failures", "n", (F.col("failures") > most).alias("unhealthy"))


def progress(attempts: DataFrame, span: str = "1 hour") -> DataFrame:
    """Attempts and successes of each tumbling window and source."""
    rows = attempts.withWatermark("ts", LATE) if attempts.isStreaming else attempts
    n = rows.groupBy(F.window("ts", span), "source").agg(F.count("*").alias("n"), F.count_if(F.expr("http_status = 200")).alias("ok"))
    return n.select(F.col("window.start").alias("start"), "source", "n", "ok")


def breaker(attempts: DataFrame, most: int = 10, cooldown_ms: int = 600_000) -> DataFrame:
    """source, ts, state: disabled at the server error that makes a run longer than ``most``, enabled again when the cooldown is over.

    All times are those of the attempts. A disabled source's attempts before the end of its cooldown count for nothing, and its run starts anew
    after it. The end is reported by the next attempt after it or, without one, when the watermark has passed it. State is two numbers a source; a source's rows of
    one micro-batch (bound its size at the source, as by ``maxFilesPerTrigger``) are taken in order of time and id.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, until = state.get if state.exists else (0, None)
        out = []
        if state.hasTimedOut:
            out.append((until, "enabled"))
            run, until = 0, None
        else:
            rows = pd.concat(list(batches))
            rows = rows.assign(ms=rows["ts"].astype("datetime64[ms]").astype("int64")).sort_values([c for c in ("ms", "attempt_id") if c == "ms" or c in rows])
            for ms, status in zip(rows["ms"].tolist(), rows["http_status"].tolist()):
                if until is not None and ms >= until:
                    out.append((until, "enabled"))
                    run, until = 0, None
                if until is None:
                    run = run + 1 if status >= 500 else 0
                    if run > most:
                        out.append((ms, "disabled"))
                        until = ms + cooldown_ms
        state.update((run, until))
        if until is not None:
            state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"source": [key[0]] * len(out), "ts": pd.to_datetime([ms for ms, _ in out], unit="ms"), "state": [x for _, x in out]})

    light = attempts.select("source", F.col("ts").cast("timestamp").alias("ts"), "http_status", *(["attempt_id"] if "attempt_id" in attempts.columns else [])).withWatermark("ts", LATE)
    return light.groupBy("source").applyInPandasWithState(update, "source string, ts timestamp, state string", "run long, until long", "append", GroupStateTimeout.EventTimeTimeout)


def stream_todo(source: DataFrame, done: DataFrame | None = None, key: str = "record_id") -> DataFrame:
    """Each id once, for ever, and none that ``done`` holds when the stream starts; the sink's checkpoint makes a restart go on where it stopped.

    The state is every id seen; on a large log keep it in the RocksDB state store, or use ``resume_todo``, which has no state.
    """
    fresh = source if done is None else source.join(done.select(key).distinct(), key, "left_anti")
    return fresh.dropDuplicates([key])


#: Attempts of this source stand for records that nothing can be looked up for.
NO_LOOKUP = "skip_no_doi"


def queue_state(attempts: DataFrame, sources: tuple[str, ...] = ()) -> DataFrame:
    """What the queue needs to know of each record, in a form that merges by ``QUEUE_RULES``; ``_tried`` holds those of ``sources`` that failed."""
    bad = F.col("bucket") != "other"
    error = F.col("error") if "error" in attempts.columns else F.lit(None).cast("string")
    at = lambda value, name: F.struct("ts", "attempt_id", value.alias(name))
    return attempts.groupBy("record_id").agg(
        F.count("*").alias("attempts"), F.min(F.when(bad, F.col("ts"))).alias("enqueued_ts"), F.max("ts").alias("last_ts"), F.min(F.when(bad, at(F.col("bucket"), "reason"))).alias("_first_bad"),
        F.max(at(F.col("source"), "source")).alias("_last"), F.max(F.when(bad, at(error, "error"))).alias("_last_bad"), F.min(F.when(~bad, at(F.col("source"), "source"))).alias("_first_ok"),
        F.max(F.col("source") == NO_LOOKUP).alias("_no"), F.collect_set(F.when(bad & F.col("source").isin(*sources) if sources else F.lit(False), F.col("source"))).alias("_tried"),
    )


QUEUE_RULES = {"attempts": F.sum, "enqueued_ts": F.min, "last_ts": F.max, "_first_bad": F.min, "_last": F.max, "_last_bad": F.max, "_first_ok": F.min, "_no": F.max, "_tried": union}


def queue_of_state(state: DataFrame, sources: tuple[str, ...] = ()) -> DataFrame:
    status = (
        F.when(F.col("_first_ok").isNotNull(), "recovered").when(F.col("_no"), "failed_no_doi")
        .when((F.size("_tried") == len(set(sources))) & F.lit(bool(sources)), "exhausted").otherwise("pending")
    )
    return state.select(
        "record_id", "attempts", F.col("_first_bad.reason").alias("reason"), "enqueued_ts", F.col("_last.source").alias("last_source"), "last_ts",
        F.col("_last_bad.error").alias("last_error"), F.col("_first_ok.source").alias("resolved_via"), status.alias("status"),
    )


def queue_from_attempts(attempts: DataFrame, sources: tuple[str, ...] = ()) -> DataFrame:
    """record_id, status, reason (of the first failure), enqueued_ts, attempts, last_source, last_ts, last_error and resolved_via, from all attempts.

    A success makes a record ``recovered``, an attempt of NO_LOOKUP ``failed_no_doi``, and failures of all ``sources``, if any are given, ``exhausted``;
    these are final, and all others are ``pending``. A record that never failed counts as recovered.
    """
    return queue_of_state(queue_state(attempts, sources), sources)


def pending_records(attempts: DataFrame, sources: tuple[str, ...] = ()) -> DataFrame:
    """record_id of each record that ``queue_from_attempts`` has as ``pending``, by a few flags a record, which are aggregated before the shuffle and without a sort."""
    bad = F.col("bucket") != "other"
    flag = lambda x, name: F.max(F.coalesce(x, F.lit(False))).alias(name)
    tried = [flag(bad & (F.col("source") == name), f"_{i}") for i, name in enumerate(sources)]
    flags = attempts.groupBy("record_id").agg(flag(~bad | (F.col("source") == NO_LOOKUP), "_final"), *tried)
    exhausted = F.lit(bool(sources))
    for i in range(len(sources)):
        exhausted = exhausted & F.col(f"_{i}")
    return flags.where(~F.col("_final") & ~exhausted).select("record_id")


def kept_state(attempts: DataFrame, path: str, sources: tuple[str, ...] = (), buckets: int = 64) -> KeptRuns:
    """The queue's state at a path; the columns follow those of ``attempts`` (a stream will do)."""
    spark = attempts.sparkSession
    empty = queue_state(spark.createDataFrame([], attempts.schema), sources)
    return KeptRuns(spark, path, ["record_id"], empty.schema, QUEUE_RULES, buckets)


def maintain_queue(attempts: DataFrame, path: str, checkpoint: str, sources: tuple[str, ...] = (), buckets: int = 64):
    """A stream that keeps the queue's state up to date; ``kept_queue`` reads the queue.

    A batch adds a run with the state of its own records, and no earlier attempt is read again; runs of like size are merged now and then. A batch that was applied before changes nothing, and readers
    see all of a batch or nothing of it. Batches are known by the checkpoint and their number, so a new checkpoint would count the same attempts anew.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        kept_state(batch, path, sources, buckets).add(queue_state(batch, sources), (checkpoint, batch_id))

    return attempts.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def kept_queue(attempts: DataFrame, path: str, sources: tuple[str, ...] = (), buckets: int = 64) -> DataFrame:
    """The queue as ``maintain_queue`` left it, as ``queue_from_attempts`` would give it."""
    return queue_of_state(kept_state(attempts, path, sources, buckets).read(), sources)


def todo_ledger(spark: SparkSession, path: str, buckets: int = 64) -> KeptRuns:
    """The ids that were given out or done before: record_id and the batch that brought it, -1 for those done."""
    return KeptRuns(spark, path, ["record_id"], "record_id string, since long", {"since": F.min}, buckets)


def resume_todo(source: DataFrame, path: str, checkpoint: str, done: DataFrame | None = None, buckets: int = 64):
    """A stream that gives each id once, and none that ``done`` holds when the ledger is made, with no state in the stream itself.

    What ``stream_todo`` keeps in its state lies in a ledger on disk: a batch is compared with the buckets that its ids fall in, and the ids that are
    new go to the ledger as one run, which is also the output: ``todo_since`` reads it. A batch that was applied before, or that failed half-way and is run again, adds nothing twice. A null id is given once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        ledger = todo_ledger(batch.sparkSession, path, buckets)
        if done is not None:
            ledger.add(done.select(F.col("record_id").cast("string").alias("record_id"), F.lit(-1).cast("long").alias("since")), ("done", 0))
        ledger.add(batch.select(F.col("record_id").cast("string").alias("record_id"), F.lit(batch_id).cast("long").alias("since")), (checkpoint, batch_id), unknown=True)

    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def todo_since(spark: SparkSession, path: str, batch: int = -1, buckets: int = 64) -> DataFrame:
    """record_id, since: the ids given out after a batch of the stream (all of them by default)."""
    return todo_ledger(spark, path, buckets).read().where(F.col("since") > max(batch, -1))


def reap_stale(items: DataFrame, now: str, minutes: int) -> DataFrame:
    """In-flight items older than ``minutes``, or with a start that can't be read, go back to pending."""
    start = F.coalesce(F.try_to_timestamp("started_at"), F.timestamp_seconds(F.lit(0)))
    stale = (F.col("status") == "in_progress") & (start < F.to_timestamp(F.lit(now)) - F.expr(f"interval {minutes} minutes"))
    return items.withColumn("error", F.when(stale, "stale claim").otherwise(F.col("error"))).withColumn("status", F.when(stale, "pending").otherwise(F.col("status")))


def claim(queue: DataFrame, n: int, worker: str) -> DataFrame:
    """The queue with its next n pending items, by time and id, in progress for the worker."""
    first = queue.where("status = 'pending'").orderBy(F.col("enqueued_ts").asc_nulls_last(), "record_id").limit(n).select("record_id", F.lit(worker).alias("_w"))
    j = queue.join(first, "record_id", "left")
    return j.withColumn("status", F.when(F.col("_w").isNotNull(), "in_progress").otherwise(F.col("status"))).withColumnRenamed("_w", "worker")


def since_days(df: DataFrame, now: str, days: int) -> DataFrame:
    return df.where(F.col("ts") >= F.to_timestamp(F.lit(now)) - F.expr(f"interval {days} days"))
