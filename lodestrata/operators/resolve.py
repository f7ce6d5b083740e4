"""Entity resolution against seeds: exact, normalized, blocked fuzzy and vector matching, and the review band."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import normalize_entity_name, resolved_id, sanitize_entity_name
from ..functions.similarity import ratio
from ..session import stage

FUZZY, ACCEPT, REVIEW = 85.0, 0.88, 0.75


def seed_names(seeds: DataFrame) -> DataFrame:
    """``canonical_id, record_type, name, pos``: canonical names and aliases of the seeds (canonical_id, name, record_type, aliases, pos)."""
    return seeds.select("canonical_id", "record_type", "pos", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))


def _lookup(names: DataFrame, key: Column) -> DataFrame:
    # the later seed wins
    return names.withColumn("mk", key).where("mk <> ''").groupBy("mk").agg(F.max_by("canonical_id", F.struct("pos", "canonical_id")).alias("matched_id"))


def seeds_of_type(seeds: DataFrame, record_type: str) -> DataFrame:
    return seeds.where(F.col("record_type") == record_type)


def seeds_by_id(seeds: DataFrame, ids: DataFrame, key: str = "canonical_id") -> DataFrame:
    """The seeds whose identifier a table names; of several with one identifier the last."""
    last = seeds.groupBy("canonical_id").agg(F.max_by(F.struct(*[c for c in seeds.columns if c != "canonical_id"]), "pos").alias("s")).select("canonical_id", "s.*")
    return last.join(ids.select(F.col(key).alias("canonical_id")).distinct(), "canonical_id", "left_semi")


def blocking_keys(name: Column) -> Column:
    """Three-letter prefix and the words of at least two letters of the normalized name."""
    n = normalize_entity_name(name)
    prefix = F.when(F.length(n) >= 3, F.concat(F.lit("p:"), F.substring(n, 1, 3)))
    words = F.transform(F.filter(F.split(n, r"\s+"), lambda w: F.length(w) >= 2), lambda w: F.concat(F.lit("t:"), w))
    return F.array_distinct(F.filter(F.concat(F.array(prefix), words), lambda x: x.isNotNull()))


def block_candidates(queries: DataFrame, names: DataFrame, per_query: int | None = 50) -> DataFrame:
    """``qid, canonical_id, name``: seeds that share a block with the query. ``per_query``: the reference's report of the first so many ids; None keeps all."""
    q = queries.select("qid", F.explode(blocking_keys(F.col("qname"))).alias("bk"))
    n = names.select("canonical_id", "name", F.explode(blocking_keys(F.col("name"))).alias("bk"))
    c = q.join(n, "bk").select("qid", "canonical_id", "name").distinct()
    if per_query is None:
        return c
    return c.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("canonical_id", "name"))).where(F.col("r") <= per_query).drop("r")


def _sorted_tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")), " ")


#: Letters are counted in so many classes; pairs of a block of queries and seeds that are compared at once.
LETTERS, PAIRS = 48, 1 << 22


def _letter_levels(names: list[str], most: int):
    """Row a name: for each class of letters and each count up to ``most``, whether the name has so many. A product of two
    rows is the number of letters that two names can share at best."""
    import numpy as np

    n = np.zeros((len(names), LETTERS), np.int64)
    for i, x in enumerate(names):
        np.add.at(n[i], [ord(c) % LETTERS for c in x], 1)
    return (n[:, :, None] > np.arange(most)).reshape(len(names), -1).astype(np.float32)


def _best_ratios(queries: list[str], seeds: list[str], levels, threshold: float, most: int):
    """(query, seed, score) of all pairs whose Indel ratio reaches the threshold. Shared letters bound it, so no pair is lost."""
    import numpy as np

    if not queries or not seeds:
        return
    size = np.array([len(x) for x in seeds], np.float32)
    step = max(1, PAIRS // len(seeds))
    for s in range(0, len(queries), step):
        part = queries[s : s + step]
        total = np.array([len(x) for x in part], np.float32)[:, None] + size
        i, j = np.nonzero(200 * (_letter_levels(part, most) @ levels.T) >= (threshold - 1e-3) * total)
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            r = ratio(part[x], seeds[y])
            if r >= threshold:
                yield s + x, y, r


def fuzzy_topk(queries: DataFrame, names: DataFrame, k: int = 5, threshold: float = FUZZY) -> DataFrame:
    """``qid, canonical_id, name, score, rank``: the ``k`` best names whose token-sort ratio with the query reaches the threshold.

    Where both tables have ``record_type``, only names of the query's own are compared. Every distinct query meets every
    distinct name of its type, no blocking: the names, a stated set, go to the tasks in blocks of a bounded size, and a matrix
    product over counts of letters rules out pairs before the ratio is computed. No pair that reaches the threshold is lost.
    """
    typed = "record_type" in queries.columns and "record_type" in names.columns
    kind = (lambda d: F.coalesce(F.col("record_type"), F.lit(""))) if typed else (lambda d: F.lit(""))
    q = queries.select("qid", _sorted_tokens(F.col("qname")).alias("qs"), kind(queries).alias("kind")).where("qs <> ''")
    n = names.select("canonical_id", "name", _sorted_tokens(F.col("name")).alias("ns"), kind(names).alias("kind")).where("ns <> ''")
    spark = queries.sparkSession
    scored = None
    distinct = q.select("kind", "qs").distinct()
    for block in _blocks(n.select("kind", "ns").distinct().orderBy("kind", "ns")):
        seeds: dict[str, list[str]] = {}
        for kd, ns in block:
            seeds.setdefault(kd, []).append(ns)
        # more letters of a class than any of these names has are shared with none
        most = max(max(Counter(ord(c) % LETTERS for c in x).values()) for v in seeds.values() for x in v)
        shared = spark.sparkContext.broadcast((seeds, most))

        def run(batches, shared=shared):
            seeds, most = shared.value
            levels = {kd: _letter_levels(v, most) for kd, v in seeds.items()}
            for b in batches:
                out = []
                for kd, g in b.groupby("kind"):
                    qs = g["qs"].tolist()
                    out += [(kd, qs[i], seeds[kd][j], round(r, 6)) for i, j, r in _best_ratios(qs, seeds.get(kd, []), levels.get(kd), threshold, most)]
                yield pd.DataFrame(out, columns=["kind", "qs", "ns", "score"])

        x = distinct.mapInPandas(run, "kind string, qs string, ns string, score double")
        scored = x if scored is None else scored.unionAll(x)
    if scored is None:
        scored = spark.createDataFrame([], "kind string, qs string, ns string, score double")
    # the window's group limit keeps k rows a group before the shuffle
    ranked = scored.join(n, ["kind", "ns"]).withColumn("rank", F.row_number().over(Window.partitionBy("kind", "qs").orderBy(F.desc("score"), "canonical_id", "name"))).where(F.col("rank") <= k)
    return q.join(ranked.drop("ns"), ["kind", "qs"]).select("qid", "canonical_id", "name", "score", "rank")


def _blocks(rows: DataFrame):
    """The rows of a stated set as tuples, in blocks of at most ``SEED_BLOCK``."""
    block: list[tuple] = []
    for r in rows.toLocalIterator():
        block.append(tuple(r))
        if len(block) == SEED_BLOCK:
            yield block
            block = []
    if block:
        yield block


#: Seeds go to the tasks in blocks of so many vectors.
SEED_BLOCK = 20_000


def vector_match(probes: DataFrame, seeds: DataFrame) -> DataFrame:
    """``pid, seed_id, score, band`` (accept, review, none): the most similar seed, ties to the smallest id; cosine, 0 for zero vectors.

    Where both tables have ``kind``, only seeds of a probe's own kind count, and a probe without any gives no row.
    The seeds are a stated set, sent to the tasks in blocks of a bounded size; every block is one scan of the probes, a matrix
    product an Arrow batch, and the best of the blocks wins. Vectors of different lengths are an error.
    """
    import numpy as np

    def scaled(v):
        x = np.stack([np.asarray(r, np.float64) for r in v])
        n = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, n, out=np.zeros_like(x), where=n > 0)

    typed = "kind" in probes.columns and "kind" in seeds.columns
    kind = F.col("kind") if typed else F.lit("").alias("kind")
    p = probes.where("vec IS NOT NULL").select("pid", "vec", kind)
    schema = f"pid {p.schema['pid'].dataType.simpleString()}, seed_id {seeds.schema['seed_id'].dataType.simpleString()}, score double"
    best = None
    for block in _blocks(seeds.where("vec IS NOT NULL").select("seed_id", "vec", kind).orderBy("seed_id")):
        shared = probes.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            by: dict[str, list] = {}
            for i, v, k in shared.value:
                by.setdefault(k, []).append((i, v))
            ready = {k: (np.array([i for i, _ in x]), scaled([v for _, v in x]).T) for k, x in by.items()}
            for b in batches:
                for k, g in b.groupby("kind"):
                    if k in ready:
                        ids, m = ready[k]
                        s = np.round(scaled(g["vec"]) @ m, 6)
                        at = s.argmax(1)  # the first of equals: blocks are in order of id
                        yield pd.DataFrame({"pid": g["pid"], "seed_id": ids[at], "score": s[np.arange(len(g)), at]})

        x = p.mapInPandas(run, schema)
        best = x if best is None else best.unionAll(x)
    if best is None:
        best = p.select("pid", F.lit(None).cast(seeds.schema["seed_id"].dataType).alias("seed_id"), F.lit(0.0).alias("score")).limit(0)
    best = best.groupBy("pid").agg(F.min(F.struct((-F.col("score")).alias("x"), "seed_id", "score")).alias("b")).select("pid", "b.seed_id", "b.score")
    return best.withColumn("band", F.when(F.col("score") >= ACCEPT, "accept").when(F.col("score") >= REVIEW, "review").otherwise("none"))


def nearest_vectors(probes: DataFrame, seeds: DataFrame) -> DataFrame:
    """As :func:`vector_match`, but for few probes against a whole table: the probes go to the tasks in blocks, the seeds are
    scanned where they lie. A seed with the probe's own id is not compared."""
    import numpy as np

    def scaled(v):
        x = np.stack([np.asarray(r, np.float64) for r in v])
        n = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, n, out=np.zeros_like(x), where=n > 0)

    s = seeds.where("vec IS NOT NULL").select("seed_id", "vec")
    p = probes.where("vec IS NOT NULL").select("pid", "vec")
    schema = f"pid {p.schema['pid'].dataType.simpleString()}, seed_id {s.schema['seed_id'].dataType.simpleString()}, score double"
    blocks: list[list] = [[]]
    for r in p.toLocalIterator():
        if len(blocks[-1]) == SEED_BLOCK:
            blocks.append([])
        blocks[-1].append((r.pid, list(r.vec)))
    out = None
    for block in blocks:
        shared = probes.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            if not shared.value:
                return
            pids = np.array([i for i, _ in shared.value])
            m = scaled([v for _, v in shared.value])
            best, at = np.full(len(pids), -np.inf), np.zeros(len(pids), pids.dtype)
            for b in batches:
                if not len(b):
                    continue
                b = b.sort_values("seed_id")
                ids = b["seed_id"].to_numpy()
                x = np.round(m @ scaled(b["vec"]).T, 6)
                x[pids[:, None] == ids[None, :]] = -np.inf
                k = x.argmax(1)  # the first of equals: a batch is in order of id
                top = x[np.arange(len(pids)), k]
                take = (top > best) | (top == best) & (top > -np.inf) & (ids[k] < at)
                best, at = np.where(take, top, best), np.where(take, ids[k], at)
            ok = best > -np.inf
            yield pd.DataFrame({"pid": pids[ok], "seed_id": at[ok], "score": best[ok]})

        x = s.mapInPandas(run, schema)
        out = x if out is None else out.unionAll(x)
    out = out.groupBy("pid").agg(F.min(F.struct((-F.col("score")).alias("x"), "seed_id", "score")).alias("b")).select("pid", "b.seed_id", "b.score")
    return out.withColumn("band", F.when(F.col("score") >= ACCEPT, "accept").when(F.col("score") >= REVIEW, "review").otherwise("none"))


def name_vectors(c: Column, dims: int = 64) -> Column:
    """A vector of a name's letter trigrams, hashed: the embedding where no model is given. Any function from a name column to
    an array column can take its place in :func:`resolve_cascade`, such as a pandas UDF around a model."""
    import zlib

    import numpy as np

    @F.pandas_udf("array<double>")
    def vectors(names: pd.Series) -> pd.Series:
        def one(x):
            x = f"  {(x or '').lower()}  "
            return np.bincount([zlib.crc32(x[i : i + 3].encode("utf-8", "surrogatepass")) % dims for i in range(len(x) - 2)], minlength=dims).astype(float)

        return names.map(one)

    return vectors(c)


def resolve_cascade(queries: DataFrame, seeds: DataFrame, fuzzy: bool = True, embed=None) -> DataFrame:
    """``qid, canonical_id, method, confidence, review_of``: exact, then normalized, then fuzzy, then by embedding, else new.

    Queries: qid, qname, record_type. Exact and normalized matches disregard the type; fuzzy and embedding ones compare seeds of
    the query's type only. ``embed`` maps a name column to a vector column; without it that stage is left out. A most similar
    seed in the review band is named in ``review_of``, and the query stays unresolved with a new identifier and the
    similarity as confidence. Each stage sees only what the one before left. A blank name is "unknown" of its type.
    """
    names = seed_names(seeds)
    qname = F.trim("qname")
    blank = F.coalesce(qname, F.lit("")) == ""
    q = queries.withColumn("mk", F.lower(qname)).join(_lookup(names, F.lower("name")).withColumnRenamed("matched_id", "e"), "mk", "left")
    q = q.withColumn("mk", sanitize_entity_name(qname)).join(_lookup(names, sanitize_entity_name(F.col("name"))).withColumnRenamed("matched_id", "m"), "mk", "left").drop("mk")
    method = F.when(blank, "unresolved").when(F.col("e").isNotNull(), "exact").when(F.col("m").isNotNull(), "normalized")
    q = q.withColumn("method", method).withColumn("canonical_id", F.when(blank, resolved_id(F.lit("unknown"), F.col("record_type"))).otherwise(F.coalesce("e", "m")))
    q = q.withColumn("confidence", F.when(F.col("method") == "exact", 1.0).when(F.col("method") == "normalized", 0.98).when(blank, 0.0))
    none = F.lit(None).cast("string")
    done = q.where("method IS NOT NULL").select("qid", "canonical_id", "method", "confidence", none.alias("review_of"))
    rest = q.where("method IS NULL").select("qid", qname.alias("qname"), "record_type")
    if fuzzy:
        top = fuzzy_topk(rest.select("qid", sanitize_entity_name(F.col("qname")).alias("qname"), "record_type"), names.select("canonical_id", sanitize_entity_name(F.col("name")).alias("name"), "record_type"), 1)
        rest = stage(rest.join(top.select("qid", "canonical_id", "score"), "qid", "left"), "fuzzy-matched")
        done = done.unionByName(rest.where("score IS NOT NULL").select("qid", "canonical_id", F.lit("fuzzy").alias("method"), (F.col("score") / 100).alias("confidence"), none.alias("review_of")))
        rest = rest.where("score IS NULL").select("qid", "qname", "record_type")
    fresh = resolved_id(F.col("qname"), F.col("record_type"))
    if embed is None:
        return done.unionByName(rest.select("qid", fresh.alias("canonical_id"), F.lit("unresolved").alias("method"), F.lit(0.0).alias("confidence"), none.alias("review_of")))
    kind = F.coalesce("record_type", F.lit(""))
    # distinct names are embedded and compared, each once a type
    probes = rest.select(F.concat_ws("\u0001", kind, "qname").alias("pid"), kind.alias("kind"), "qname").distinct().select("pid", "kind", embed(F.col("qname")).alias("vec"))
    best = vector_match(probes, seeds.where("trim(name) <> ''").select(F.col("canonical_id").alias("seed_id"), kind.alias("kind"), embed(F.col("name")).alias("vec")))
    x = rest.withColumn("pid", F.concat_ws("\u0001", kind, "qname")).join(best.where("score > 0"), "pid", "left")
    accept = F.coalesce(F.col("band") == "accept", F.lit(False))
    review = F.coalesce(F.col("band") == "review", F.lit(False))
    return done.unionByName(x.select(
        "qid", F.when(accept, F.col("seed_id")).otherwise(fresh).alias("canonical_id"), F.when(accept, "embedding").otherwise("unresolved").alias("method"),
        F.when(accept | review, F.col("score")).otherwise(0.0).alias("confidence"), F.when(review, F.col("seed_id")).alias("review_of"),
    ))


def edge_endpoints(edges: DataFrame, seeds: DataFrame, embed=None) -> DataFrame:
    """``edges`` (source, target, record_type, ...) plus source_id and target_id: both names resolved, each distinct name once.

    Both ends are resolved with the record type of the page that states the edge.
    """
    ends = edges.select(F.col("source").alias("qname"), "record_type").unionAll(edges.select(F.col("target").alias("qname"), "record_type")).where("qname IS NOT NULL").distinct()
    key = lambda c: F.concat_ws("\u0001", F.coalesce("record_type", F.lit("")), c)
    got = stage(resolve_cascade(ends.withColumn("qid", key("qname")), seeds, embed=embed).select("qid", "canonical_id"), "endpoints")
    x = edges.withColumn("a", key("source")).withColumn("b", key("target"))
    x = x.join(got.select(F.col("qid").alias("a"), F.col("canonical_id").alias("source_id")), "a", "left").join(got.select(F.col("qid").alias("b"), F.col("canonical_id").alias("target_id")), "b", "left")
    return x.drop("a", "b")


# States of a review that still wait.
WAITING = ("pending", "needs_review")


def pending_reviews(items: DataFrame, record_type: str | None = None) -> DataFrame:
    """Items that need a review, of one type if given."""
    d = items.where("status = 'needs_review'")
    return d if record_type is None else d.where(F.col("record_type") == record_type)


def review_counts(items: DataFrame, by: str = "record_type") -> DataFrame:
    """``by, total, pending, resolved``."""
    waits = F.col("status").isin(*WAITING)
    return items.groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count_if(waits).alias("pending"), F.count_if(~waits).alias("resolved"))
