"""Streaming: duplicate-free messages, event windows, dead letters, idempotent upserts and circuit breakers."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.redelivery import message_key
from ..session import _fs, shared_dir


def read_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A parquet folder (or file) as a stream; ``files`` bounds a micro-batch, which is the back-pressure."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    path = path.rstrip("/")
    # a pattern, since a plain path to one file is taken for the base folder of partitions
    return (r.option("maxFilesPerTrigger", files) if files else r).parquet(f"{path[:-1]}[{path[-1]}]")


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder on shared storage, removed when the driver's JVM ends."""
    base = f"{shared_dir(spark)}/lodestrata/{name}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, base)
    fs.deleteOnExit(p)
    return base


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there and returns what it wrote (in complete mode: its last state)."""
    spark = stream.sparkSession
    base = own_folder(spark, name)
    if mode == "append":
        w = stream.writeStream.format("parquet").option("path", f"{base}/out")
    else:
        w = stream.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{base}/out"))
    w.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def dedup_messages(stream: DataFrame, delay: str = "30 days", seen_at: str = "received_at") -> DataFrame:
    """``uid``: each message identifier once within the watermark."""
    d = stream.select(message_key(F.col("message_id")).alias("uid"), F.col(seen_at).cast("timestamp").alias("seen_at")).where("uid IS NOT NULL AND seen_at IS NOT NULL")
    return d.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["uid"]).select("uid")


def dedup_urls(stream: DataFrame, key, source: str, ts: str, delay: str = "30 days") -> DataFrame:
    """``dup_key, source, day``: each page once per source and UTC day; what is known is kept as state for ``delay``."""
    d = stream.select(key.alias("dup_key"), F.col(source), F.col(ts).cast("timestamp").alias("at")).where("dup_key IS NOT NULL AND at IS NOT NULL").withColumn("day", F.to_date("at"))
    return d.withWatermark("at", delay).dropDuplicatesWithinWatermark(["dup_key", source, "day"]).select("dup_key", source, "day")


def dedup_contents(stream: DataFrame, content: str, source: str) -> DataFrame:
    """``content, source``: each content once per source, for good: the state has every pair ever seen."""
    return stream.select(content, source).where(F.col(content).isNotNull()).dropDuplicates([content, source])


def retry_failed(stream: DataFrame, handle, path: str, checkpoint: str, most: int = 5):
    """Starts a consumer: ``handle(df)`` gives df plus ``error`` (null for success); a failed message is written to ``path/retry``
    with one attempt more, or to ``path/dead`` once ``most`` are used up. Every micro-batch writes its own folder, so one that
    is repeated after a crash replaces itself."""

    def run(df: DataFrame, batch: int) -> None:
        done = handle(df).withColumn("attempt", F.coalesce("attempt", F.lit(0)) + F.when(F.col("error").isNull(), 0).otherwise(1)).persist()
        for part, rows in (("done", F.col("error").isNull()), ("retry", F.col("error").isNotNull() & (F.col("attempt") < most)), ("dead", F.col("error").isNotNull() & (F.col("attempt") >= most))):
            done.where(rows).write.mode("overwrite").parquet(f"{path}/{part}/batch={batch}")
        done.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def export_every(stream: DataFrame, path: str, checkpoint: str, minutes: int | None = 30):
    """Starts an export that appends what is new every so many minutes (None: all that is there, once), exactly once a row."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if minutes is None else w.trigger(processingTime=f"{minutes} minutes")).start()


def chain(stream: DataFrame, steps: dict, path: str) -> dict[str, DataFrame]:
    """Runs a topology of streams: every step (name: function of a stream) is a query of its own, with its own checkpoint, that
    writes Parquet to ``path/<name>`` and is read as a stream by the next. Returns the tables by name.

    A step that fails is taken up where its checkpoint stands; the file sink writes every row once.
    """
    out, spark = {}, stream.sparkSession
    for name, step in steps.items():
        d = step(stream)
        d.writeStream.format("parquet").option("path", f"{path}/{name}").option("checkpointLocation", f"{path}/_checkpoints/{name}").trigger(availableNow=True).start().awaitTermination()
        out[name] = spark.read.schema(d.schema).parquet(f"{path}/{name}")
        stream = spark.readStream.schema(d.schema).parquet(f"{path}/{name}")
    return out


def window_counts(stream: DataFrame, ts: str, key: str, width: str = "1 hour", delay: str = "1 day") -> DataFrame:
    d = stream.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", delay)
    return d.groupBy(F.window("at", width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.unix_micros("w.start").alias("start_us"), key, "n")


def dead_letters(stream: DataFrame, max_attempts: str = "max_attempts") -> DataFrame:
    """Messages with the reason that sends them to the dead letters; null for good ones."""
    reason = (
        F.when(message_key(F.col("message_id")).isNull(), "missing_identifier").when(F.coalesce(F.trim("url"), F.lit("")) == "", "missing_url").when(F.col("attempt") >= F.col(max_attempts), "attempts_exhausted")
    )
    return stream.withColumn("error", reason)


def upsert_batches(stream: DataFrame, path: str, key: str, order: list[str], checkpoint: str):
    """Starts an upsert into a table of deltas: every micro-batch writes the last rows of its own keys, nothing else is rewritten.

    A micro-batch writes the folder of its query and number, so one that is repeated after a failure replaces itself; a query
    with a new checkpoint adds to what is there. :func:`read_upserts` gives the table, :func:`compact_upserts` merges deltas.
    """
    from ..operators.upserts import last_rows

    def merge(df: DataFrame, batch: int) -> None:
        run = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
        last_rows(df, [key], order).write.mode("overwrite").parquet(f"{path}/deltas/run={run}/batch={batch}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _parts(spark: SparkSession, path: str, key: str) -> list[str]:
    """Complete folders ``path/.../key=...``."""
    fs, p = _fs(spark, f"{path}/{key}=*/_SUCCESS")
    return sorted(f.getPath().getParent().toString() for f in fs.globStatus(p) or [])


def _upsert_parts(spark: SparkSession, path: str) -> tuple[str | None, list[str]]:
    """The last compacted table and the deltas that are not in it."""
    base = max(_parts(spark, f"{path}/compacted", "v"), key=lambda x: int(x.rsplit("=", 1)[1]), default=None)
    merged = {r[0] for r in spark.read.text(base.replace("/compacted/v=", "/compacted/parts-")).collect()} if base else set()
    return base, [x for x in _parts(spark, f"{path}/deltas/run=*", "batch") if x.split("/deltas/")[1] not in merged]


def read_upserts(spark: SparkSession, path: str, schema, key: str, order: list[str]) -> DataFrame:
    """The table that :func:`upsert_batches` wrote: the last row of every key over all deltas."""
    from ..operators.upserts import last_rows

    base, deltas = _upsert_parts(spark, path)
    parts = [base, *deltas] if base else deltas
    return last_rows(spark.read.schema(schema).parquet(*parts), [key], order) if parts else spark.createDataFrame([], schema)


def compact_upserts(spark: SparkSession, path: str, schema, key: str, order: list[str]) -> None:
    """Merges all deltas into a new table, named after what it holds before it counts; older parts stay for running readers."""
    base, deltas = _upsert_parts(spark, path)
    if deltas:
        v = int(base.rsplit("=", 1)[1]) + 1 if base else 0
        old = [r[0] for r in spark.read.text(base.replace("/compacted/v=", "/compacted/parts-")).collect()] if base else []
        names = spark.createDataFrame([(x.split("/deltas/")[1],) for x in deltas] + [(x,) for x in old], "value string")
        names.coalesce(1).write.mode("overwrite").text(f"{path}/compacted/parts-{v}")
        read_upserts(spark, path, schema, key, order).write.mode("overwrite").parquet(f"{path}/compacted/v={v}")


def breaker_steps(calls, state=("CLOSED", 0, 0, 0), failures: int = 5, open_us: int = 60_000_000, probes: int = 2):
    """Runs (time in microseconds, ok) calls through a breaker; yields (time, state before, admitted) and returns the last state.

    So many failures open it; after the pause it is half open and lets ``probes`` calls through; a success closes it.
    """
    name, fails, since, tried = state
    for at, ok in calls:
        if name == "OPEN" and at - since >= open_us:
            name, tried = "HALF_OPEN", 0
        admitted = name == "CLOSED" or name == "HALF_OPEN" and tried < probes
        yield at, name, admitted
        if not admitted:
            continue
        tried += name == "HALF_OPEN"
        if ok:
            name, fails = "CLOSED", 0
        else:
            fails += 1
            if name == "HALF_OPEN" or fails >= failures:
                name, since = "OPEN", at
    return name, fails, since, tried


def circuit_breaker(stream: DataFrame, key: str, ts: str, ok: str, failures: int = 5, open_us: int = 60_000_000) -> DataFrame:
    """``key, at_us, state, admitted`` of every call, with the breaker of each key kept as state between micro-batches.

    A breaker is one sequence of calls, so the calls of one key in one micro-batch are one task's; ``read_stream(files=...)``
    bounds a micro-batch. Calls are held as two plain arrays, not as frames.
    """
    d = stream.select(F.col(key).alias("k"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), F.col(ok).alias("ok")).where("k IS NOT NULL AND at IS NOT NULL")

    def run(k, frames, state):
        now = state.get if state.exists else ("CLOSED", 0, 0, 0)
        parts = [(f["at"].to_numpy(np.int64), f["ok"].to_numpy(bool)) for f in frames]
        at, fine = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.lexsort((fine, at))
        steps, out = breaker_steps(zip(at[by].tolist(), fine[by].tolist(), strict=True), tuple(now), failures, open_us), []
        while True:
            try:
                out.append(next(steps))
            except StopIteration as end:
                now = end.value
                break
        state.update(tuple(now))
        yield pd.DataFrame([(k[0], *r) for r in out], columns=["k", "at_us", "state", "admitted"])

    out = d.groupBy("k").applyInPandasWithState(run, "k string, at_us long, state string, admitted boolean", "name string, fails long, since long, tried long", "append", GroupStateTimeout.NoTimeout)
    return out.withColumnRenamed("k", key)
