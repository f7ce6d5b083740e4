"""Session helpers: table loading, clash-safe names, and lineage cutting on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings crawl_manifests queue_messages "
    "source_assertions review_items parsed_dates startups papers jobs raw_pages eval_items source_registry pack_targets"
).split()


def build_session(app: str = "lodestrata", **conf: str) -> SparkSession:
    """A session with the settings every operator expects (UTC, AQE)."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``; a temporary one only where it is unset (tests, local runs)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        own = getattr(spark, "_lodestrata_dir", None)
        if own is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            own = tempfile.mkdtemp(prefix="lodestrata-")
            spark._lodestrata_dir = own  # type: ignore[attr-defined]
        d = f"file://{own}"
    return d.rstrip("/")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def stage(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The files outlive lost executors, and are removed when the driver's JVM ends or by :func:`discard`. ``metrics``, aggregates
    by name, are taken while the table is written; :func:`measured` tells them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodestrata/{name}-{uuid.uuid4().hex}"
    seen = Observation(f"{name}-{uuid.uuid4().hex}") if metrics else None
    (df.observe(seen, *[c.alias(k) for k, c in metrics.items()]) if seen else df).write.parquet(path)
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._lodestrata_path = path  # type: ignore[attr-defined]
    out._lodestrata_metrics = seen.get if seen else {}  # type: ignore[attr-defined]
    return out


def measured(df: DataFrame, name: str):
    """What :func:`stage` measured; None for an aggregate of no rows."""
    return df._lodestrata_metrics.get(name)  # type: ignore[attr-defined]


def discard(df: DataFrame | None) -> None:
    """Remove what :func:`stage` wrote, once nothing reads it any more."""
    path = getattr(df, "_lodestrata_path", None)
    if path:
        fs, p = _fs(df.sparkSession, path)
        fs.delete(p, True)
