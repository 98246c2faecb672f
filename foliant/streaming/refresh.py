"""The index kept up to date by micro-batches, and event streams with late data."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from foliant.operators.index import upsert, upsert_counts
from foliant.operators.store import Store


def refresh_index(
    spark: SparkSession, incoming: str, schema: str, index_path: str, checkpoint: str, key: str, version: str,
    on_batch: Callable[[int, dict], None] | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None, model: str | None = None,
    most_attempts: int = 2, failing_batches: int = 5,
) -> StreamingQuery:
    """Files that arrive in ``incoming`` are put into the stored index by key, the greatest ``version`` winning.

    A batch that is run again after a failure gives the same index: writing is by key, and an older version never replaces a
    newer one. An index that can't be read stops the stream and stays as it is. ``on_batch`` is told the counts of each batch
    (total, processed, added, updated, recovered, skipped, errors).

    ``prepare`` may fill in columns and mark rows it could not do by a text in the column ``error``; such rows are kept in a
    queue beside the index and tried again with the next batch, ``most_attempts`` times in all. After ``failing_batches``
    batches without one good row the stream stops. ``model`` names what made the vectors; an index of another model is emptied first.
    """
    store = Store(spark, index_path, schema, key)
    queue = Store(spark, f"{index_path.rstrip('/')}-failed", schema + ", attempts int, error string", key)
    failing = [0]
    if model is not None:
        store.for_model(model)

    def put(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c != key]
        waiting = queue.read().filter(F.col("attempts") < most_attempts)
        arrived = batch.withColumn("attempts", F.lit(0)).unionByName(waiting.drop("error"))
        newest = arrived.groupBy(key).agg(F.max_by(F.struct(*rest, "attempts"), F.struct(version, -F.col("attempts"))).alias("r")).select(key, "r.*")
        done = prepare(newest) if prepare else newest
        if "error" not in done.columns:
            done = done.withColumn("error", F.lit(None).cast("string"))
        done = done.persist()
        try:
            state = store.manifest()
            good = done.filter("error is null")
            buckets = store.touched(good, state)
            index = store.read(state, buckets)
            known = index.select(key, F.col(version).alias("_have"))
            fresh = good.join(known, key, "left").filter("_have is null or _have <= " + version).drop("_have").persist()
            sizes = done.agg(F.count("*").alias("total"), F.count("error").alias("errors"), F.count_if(F.col("error").isNull() & (F.col("attempts") > 0)).alias("recovered")).first().asDict()
            counts = upsert_counts(index, fresh, key).first().asDict()
            store.replace(upsert(index, fresh.drop("attempts", "error"), key), buckets, state, model=model, last_update=datetime.now(timezone.utc).isoformat())
            waited = queue.manifest()
            queued = queue.touched(done, waited)
            held = queue.read(waited, queued).join(done.select(key), key, "left_anti")
            queue.replace(held.unionByName(done.filter("error is not null").withColumn("attempts", F.col("attempts") + 1)), queued, waited)
            fresh.unpersist()
        finally:
            done.unpersist()
        if on_batch is not None:
            on_batch(number, sizes | counts | {"skipped": sizes["total"] - sizes["errors"] - counts["processed"]})
        failing[0] = failing[0] + 1 if sizes["total"] and sizes["errors"] == sizes["total"] else 0
        if failing[0] >= failing_batches:
            raise RuntimeError(f"{failing_batches} batches without one good row")

    stream = spark.readStream.schema(schema).parquet(incoming)
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and totals by type and time window; events later than ``late`` are left out, state is bounded by it."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return events.withWatermark("ts", late).groupBy("event_type", w.alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("event_type", F.col("w.start").alias("started"), "n", "total")


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("started"), "n")


def running_totals(events: DataFrame) -> DataFrame:
    """(user_id, n, total) after each batch: a state of two numbers per user."""

    def update(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in batches:
            n, total = n + len(pdf), total + float(pdf["value"].sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [total]})

    return events.groupBy("user_id").applyInPandasWithState(update, "user_id long, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)
