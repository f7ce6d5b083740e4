"""Messages delivered more than once: keep one delivery of each identifier.

Deliveries are laid into time buckets. Identifiers' hashes are partitioned by hash, so that all copies of one meet in a task;
there each bucket gets a Bloom filter of its identifiers, sized by their number, and a hash that hits no filter but its own
bucket's, and that one once, is definitely new and goes no further. Only possible repeats are stored and verified exactly.
Nothing is broadcast and the driver sees one row of counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import path_exists, stage

BITS_PER_ID = 32
BUCKETS = 32
#: Hashes that a task holds (before copies within its input batches are dropped).
TASK_IDS = 1_000_000


def message_key(c: Column) -> Column:
    """The 32 hex digits of an identifier however spelled; another non-blank text stands for itself; null if blank."""
    s = F.regexp_replace(F.lower(c), r"[\s ​﻿]", "")
    d = F.regexp_replace(F.regexp_replace(s, r"^(urn:)?(uuid:)?", ""), r"[-{}()_:.]", "")
    return F.when(d.rlike("^[0-9a-f]{32}$"), d).when(s != "", F.concat(F.lit("="), s))


def _bits(h: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and mask of four bits in that word, from a 64-bit hash."""
    u = h.view(np.uint64)
    m = np.zeros(len(u), np.uint64)
    for i in range(4):
        m |= np.uint64(1) << ((u >> np.uint64(6 * i)) & np.uint64(63))
    return ((u >> np.uint64(24)) & np.uint64(words - 1)).astype(np.int64), m


def _words(n: int) -> int:
    return 1 << max(4, int(np.ceil(np.log2(max(1, n) * BITS_PER_ID / 64))))


def screen(h: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The hashes that may occur twice, of distinct (hash, bucket) with their number of deliveries: several deliveries in one
    bucket, or a hit in another bucket's filter."""
    maybe = n > 1
    filters = []
    for x in np.unique(bucket):
        mine = np.flatnonzero(bucket == x)
        words = _words(len(mine))
        w, m = _bits(h[mine], words)
        f = np.zeros(words, np.uint64)
        np.bitwise_or.at(f, w, m)
        filters.append((x, f))
    for x, f in filters:
        w, m = _bits(h, len(f))
        maybe |= ((f[w] & m) == m) & (bucket != x)
    return np.unique(h[maybe])


def possible_repeats(keyed: DataFrame, parts: int) -> DataFrame:
    """``h``: hashes of ``keyed`` (``h``, ``tb``) that may occur twice, as the filters of the time buckets tell."""

    def count(batches):
        # copies within a batch of input become one row, so a hot identifier does not fill its partition
        for b in batches:
            u = b.groupby(["h", "tb"], sort=False).size().reset_index(name="n")
            yield u.astype({"n": "int64"})

    def probe(batches):
        got = list(batches)
        if not got:
            return
        b = pd.concat(got).groupby(["h", "tb"], sort=False)["n"].sum().reset_index()
        yield pd.DataFrame({"h": screen(b["h"].to_numpy(np.int64), b["tb"].to_numpy(np.int64), b["n"].to_numpy(np.int64))})

    return keyed.select("h", "tb").mapInPandas(count, "h long, tb long, n long").repartition(parts, "h").mapInPandas(probe, "h long")


def _keyed(df: DataFrame, row_id: str, message_id: str, attempt: str, seen_at: str) -> DataFrame:
    return df.select(
        F.col(f"`{row_id}`").alias("rid"), message_key(F.col(f"`{message_id}`")).alias("uid"), F.col(f"`{attempt}`").cast("long").alias("att"), F.unix_micros(F.col(f"`{seen_at}`").cast("timestamp")).alias("us")
    ).where("uid IS NOT NULL AND rid IS NOT NULL").withColumn("h", F.xxhash64("uid"))


def _order():
    """The delivery that stays: lowest attempt, null last, then smallest row."""
    return F.struct(F.col("att").isNull().alias("last"), "att", "rid")


def surplus_deliveries(df: DataFrame, row_id: str = "entry_id", message_id: str = "message_id", attempt: str = "attempt", seen_at: str = "received_at") -> DataFrame:
    """One row ``row_id`` per surplus delivery: all but the one with the lowest ``attempt`` (null last), then the smallest ``row_id``.

    Defined cases: a null or blank identifier is never a copy; a null ``seen_at`` falls into the first bucket; rows repeated
    with the same ``row_id`` are one delivery; a null ``row_id`` is left out, since it cannot be named; an empty table gives
    an empty table; identifiers of any length are compared whole; other columns are ignored. A single identifier holding
    most rows is pre-aggregated to one candidate a task, and the surplus is found by an anti join on the unique ``row_id``.
    """
    keyed = _keyed(df, row_id, message_id, attempt, seen_at)
    at = F.unix_micros(F.col(f"`{seen_at}`").cast("timestamp"))
    n, lo, hi = df.select(F.count(F.lit(1)), F.min(at), F.max(at)).first()
    width = max(1, ((hi or 0) - (lo or 0)) // BUCKETS + 1)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_IDS))
    keyed = keyed.withColumn("tb", F.coalesce(F.floor((F.col("us") - F.lit(lo or 0)) / F.lit(width)), F.lit(0)).cast("long"))
    candidates = stage(keyed.join(possible_repeats(keyed, parts), "h", "left_semi").select("rid", "uid", "att"), "possible-repeats")
    keep = candidates.groupBy("uid").agg(F.min(_order()).alias("k")).select(F.col("k.rid").alias("rid"))
    return candidates.select("rid").distinct().join(keep, "rid", "left_anti").select(F.col("rid").alias(row_id))


class DeliveryLedger:
    """Accepted identifiers on shared storage, for batches that arrive one after another.

    ``ids/batch=<id>/tb=<bucket>/`` holds the accepted identifiers by batch and time bucket (``DAYS`` days of ``seen_at``),
    ``filters/batch=<id>/`` each bucket's Bloom filter words, sized by the bucket's identifiers. A batch's identifiers are
    screened against the filters of all other batches; possible repeats are verified only against the buckets whose filter has
    them. The first accepted delivery of an identifier stays.

    A batch that is given again under its id replaces what it wrote and gives the same answer. Filters are written before
    identifiers: a failure in between leaves filters that let more through to the exact step, never an identifier unseen.
    """

    DAYS = 32

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, part: str, schema: str, batch_id: int) -> DataFrame | None:
        path = f"{self.path}/{part}"
        return self.spark.read.schema(schema).parquet(path).where(F.col("batch") != batch_id) if path_exists(self.spark, path) else None

    def accept(self, batch: DataFrame, batch_id: int, row_id: str = "entry_id", message_id: str = "message_id", attempt: str = "attempt", seen_at: str = "received_at") -> DataFrame:
        """Adds the batch's new identifiers and returns the batch's surplus ``row_id``s."""
        bucket = F.coalesce(F.floor(F.col("us") / F.lit(self.DAYS * 86_400_000_000)), F.lit(-1)).cast("long")
        rows = stage(_keyed(batch, row_id, message_id, attempt, seen_at).withColumn("tb", bucket), "ledger-batch")
        mask = F.lit(0).cast("long")
        for i in range(4):
            mask = mask.bitwiseOR(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {6 * i}) & 63 AS int))"))
        word = F.shiftrightunsigned("h", 24).bitwiseAND(F.col("words") - 1)
        firsts = rows.groupBy("uid").agg(F.min(F.struct(F.col("att").isNull().alias("last"), "att", "rid", "tb", "h")).alias("k")).select("uid", "k.rid", "k.tb", "k.h").withColumn("m", mask)
        filters = self._read("filters", "words long, w long, m long, tb long, batch long", batch_id)
        if filters is not None:
            # sizes are powers of two, so there are few; each identifier has one word in a filter of each size
            sizes = [F.lit(r.words) for r in filters.select("words").distinct().collect()] or [F.lit(1)]
            at = firsts.select("uid", "h", "m", F.explode(F.array(*sizes)).alias("words")).withColumn("w", word)
            hits = at.join(filters.select("words", "w", F.col("m").alias("fm"), "tb", "batch"), ["words", "w"]).where(F.col("fm").bitwiseAND(F.col("m")) == F.col("m")).select("uid", "tb", "batch").distinct()
            known = hits.join(self._read("ids", "uid string, batch long, tb long", batch_id), ["uid", "batch", "tb"], "left_semi").select("uid").distinct()
            firsts = firsts.join(known, "uid", "left_anti")
        firsts = stage(firsts, "ledger-new")
        size = firsts.groupBy("tb").agg(F.count(F.lit(1)).alias("n")).select("tb", F.expr(f"shiftleft(1L, greatest(4, cast(ceil(log2(n * {BITS_PER_ID} / 64)) AS int)))").alias("words"))
        firsts.join(size, "tb").groupBy("tb", "words", word.alias("w")).agg(F.bit_or("m").alias("m")).write.mode("overwrite").parquet(f"{self.path}/filters/batch={batch_id}")
        firsts.select("uid", "tb").write.mode("overwrite").partitionBy("tb").parquet(f"{self.path}/ids/batch={batch_id}")
        return rows.select("rid").distinct().join(firsts.select("rid"), "rid", "left_anti").select(F.col("rid").alias(row_id))
