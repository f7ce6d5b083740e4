"""Consolidating pairwise matches into groups.

The match graph is reduced before it is solved: vertices of degree one are stripped, chains of vertices of degree two are
compressed by list ranking (pointer jumping over the chain's arcs), and both are repeated while they shrink the graph.
What is left, the core, is solved by large-star/small-star rounds. Labels are then restored to the removed vertices by
pointer doubling over the log of removals, and every group gets its smallest member as identifier. Every step is a join or an aggregation on long
integers; each round is written to the shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import discard, measured, stage

NOTHING = ("", "n/a", "unknown", "-", "none", "null", "tbd")


def _both(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _ends(e: DataFrame) -> DataFrame:
    """Degree, smallest and largest neighbour of each vertex."""
    return _both(e).groupBy("u").agg(F.count(F.lit(1)).alias("deg"), F.min("v").alias("a"), F.max("v").alias("b"))


def _rows() -> Column:
    return F.count(F.lit(1))


def _strip(e: DataFrame, name: str) -> tuple[DataFrame, DataFrame, int]:
    """Removes the vertices of degree one: (log of vertex and parent, remaining edges, number removed)."""
    d = _ends(e).where("deg = 1").select("u", F.col("a").alias("parent"))
    # of a lone edge's two leaves only the larger goes, so its parent stays
    log = d.join(d.select(F.col("u").alias("parent"), F.col("parent").alias("u"), F.lit(1).alias("lone")), ["u", "parent"], "left").where("lone IS NULL OR u > parent").select("u", "parent")
    log = stage(log, f"{name}-leaves", n=_rows())
    n = measured(log, "n") or 0
    if not n:
        return log, e, 0
    gone = log.select(F.least("u", "parent").alias("u"), F.greatest("u", "parent").alias("v"))
    return log, stage(e.join(gone, ["u", "v"], "left_anti"), f"{name}-edges"), n


def _doubled(p: DataFrame, table: DataFrame) -> DataFrame:
    """Arcs ``p`` carried on by what ``table`` says of the arcs they end at, twice: reach 1 becomes 3."""
    q = table.select(F.col("f").alias("nf"), F.col("x").alias("nx"), F.col("nf").alias("f2"), F.col("nx").alias("x2"), F.col("done").alias("d2"), F.col("rank").alias("r2"), F.col("low").alias("l2"))
    for _ in range(2):
        step = p.join(q, ["nf", "nx"], "left")
        on = ~F.col("done")
        p = step.select(
            "f", "x", F.when(on, F.col("f2")).otherwise(F.col("nf")).alias("nf"), F.when(on, F.col("x2")).otherwise(F.col("nx")).alias("nx"), F.when(on, F.col("d2")).otherwise(F.col("done")).alias("done"),
            F.when(on, F.col("rank") + F.col("r2")).otherwise(F.col("rank")).alias("rank"), F.when(on, F.least("low", "l2")).otherwise(F.col("low")).alias("low"),
        )
    return p


def _compress(e: DataFrame, name: str) -> tuple[DataFrame, DataFrame, int | None]:
    """Replaces every chain of degree-two vertices by one edge: (log, remaining edges, their number; None: nothing to compress)."""
    two = stage(_ends(e).where("deg = 2").select(F.col("u").alias("x"), "a", "b"), f"{name}-two", n=_rows())
    if not measured(two, "n"):
        return two.select(F.col("x").alias("u"), F.col("a").alias("parent")), e, None
    inner = two.select("x")
    left = {"n": F.count_if(~F.col("done")), "low": F.sum(F.when(~F.col("done"), F.col("low").cast("decimal(38,0)")))}
    # an arc enters x from one neighbour and leaves to the other; it ends where that other one is no chain vertex
    arcs = two.select(F.col("a").alias("f"), "x", F.col("b").alias("to")).unionAll(two.select(F.col("b").alias("f"), "x", F.col("a").alias("to")))
    p = stage(
        arcs.join(inner.select(F.col("x").alias("to"), F.lit(True).alias("more")), "to", "left").select(
            "f", "x", F.col("x").alias("nf"), F.col("to").alias("nx"), F.col("more").isNull().alias("done"), F.lit(1).cast("long").alias("rank"), F.least("x", "to").alias("low")
        ),
        f"{name}-arcs", **left,
    )
    before = None
    while True:
        now = measured(p, "n") or 0, measured(p, "low")
        if now[0] == 0 or now == before:  # all ranked, or only rings are left and their minimum went all round
            break
        before = now
        nxt = stage(_doubled(p, p), f"{name}-rank", **left)
        discard(p)
        p = nxt
    ends = p.groupBy("x").agg(F.bool_and("done").alias("chain"), F.min("nx").alias("e1"), F.max("nx").alias("e2"), F.min("rank").alias("near"), F.min("low").alias("low"))
    ends = stage(ends, f"{name}-ends")
    discard(p)
    log = ends.select(F.col("x").alias("u"), F.when(F.col("chain"), F.col("e1")).otherwise(F.col("low")).alias("parent")).where("u <> parent")
    # the vertex next to an end (rank 1) speaks for its chain
    short = ends.where("chain AND near = 1 AND e1 <> e2").select(F.col("e1").alias("u"), F.col("e2").alias("v"))
    kept = e.join(inner.select(F.col("x").alias("u")), "u", "left_anti").join(inner.select(F.col("x").alias("v")), "v", "left_anti").select("u", "v")
    edges = stage(kept.unionAll(short).distinct(), f"{name}-edges", n=_rows())
    discard(two)
    return log, edges, measured(edges, "n") or 0


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One star round on edges (u, v) with u > v."""
    n = _both(e) if large else e.select("u", "v")
    low = n.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        out = n.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = n.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _core(e: DataFrame) -> DataFrame:
    """Stars of the core: (u, parent)."""
    sums = {"n": _rows(), "sum": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    e = stage(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "core", **sums)
    before = None
    while True:
        now = measured(e, "n") or 0, measured(e, "sum")
        if now[0] == 0 or now == before:
            return e.select("u", F.col("v").alias("parent"))
        before = now
        nxt = stage(_star(_star(e, True), False), "core", **sums)
        discard(e)
        e = nxt


def _roots(forest: DataFrame, depth: int) -> DataFrame:
    """Restores labels: every vertex of the forest (u, parent) with its root, by pointer jumping."""
    f = stage(forest, "forest")
    reach = 1
    while reach < depth:
        up = f.select(F.col("u").alias("parent"), F.col("parent").alias("next"))
        g = f
        for _ in range(2):  # two steps on the same table: the reach is three times as long
            g = g.join(up, "parent", "left").select("u", F.coalesce("next", "parent").alias("parent"))
        g = stage(g, "forest")
        discard(f)
        f, reach = g, reach * 3
    return f


def group_links(pairs: DataFrame, left: str = "src", right: str = "dst", id_col: str = "id", group_col: str = "group_id", shrink: float = 0.9) -> DataFrame:
    """``id_col, group_col``: every vertex of the linked ``pairs`` (long integers) with the smallest vertex of its group.

    Reducing stops once a pass leaves more than ``shrink`` of the edges; the rest is the core.

    Defined cases: a pair with a null side links nothing and its other side gives no row of its own; a pair of a vertex with
    itself gives that vertex as a group; repeated and reversed pairs count once; no pairs give no rows; other columns are
    ignored. The number of links of one vertex is not bounded: vertices are aggregated before they are shuffled.
    """
    raw = pairs.select(F.col(f"`{left}`").cast("long").alias("u"), F.col(f"`{right}`").cast("long").alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    e = stage(raw.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "pairs", n=F.count_if(F.col("u") != F.col("v")), loops=F.count_if(F.col("u") == F.col("v")))
    loops = e.where("u = v").select("u")
    cur, n = e.where("u <> v"), measured(e, "n") or 0
    logs: list[DataFrame] = []
    while n:
        name = f"pass{len(logs)}"
        log, nxt, gone = _strip(cur, name)
        if gone:
            logs.append(log)
        rest, after = n - gone, None
        if rest:
            log, nxt, after = _compress(nxt, name)
            if after is not None:
                logs.append(log)
                rest = after
        done = rest > shrink * n or after is None
        if cur is not nxt:
            discard(cur)
        cur, n = nxt, rest
        if done:
            break
    if n:
        logs.append(_core(cur))
    if not logs:
        return loops.select(F.col("u").alias(id_col), F.col("u").alias(group_col))
    # every removed vertex has one parent that went later or stayed: a forest whose depth is the number of steps
    labels = logs[0]
    for log in logs[1:]:
        labels = labels.unionAll(log)
    labels = _roots(labels, len(logs))
    for log in logs:
        discard(log)
    low = labels.groupBy("parent").agg(F.min("u").alias("m")).select(F.col("parent"), F.least("parent", "m").alias("g"))
    members = labels.join(low, "parent").select(F.col("u").alias(id_col), F.col("g").alias(group_col))
    roots = low.select(F.col("parent").alias(id_col), F.col("g").alias(group_col))
    out = members.unionAll(roots)
    alone = loops.join(out.select(F.col(id_col).alias("u")), "u", "left_anti").select(F.col("u").alias(id_col), F.col("u").alias(group_col))
    return out.unionAll(alone)


def group_by_shared_keys(df: DataFrame, id_col: str, keys: list[str], group_col: str = "group_id") -> DataFrame:
    """``id_col, group_col``: rows that share any of ``keys`` directly or indirectly; the smallest id names the group.

    Every key is stood for by the smallest id that has it, so a key that most rows have becomes one vertex, and rows become
    pairs of such vertices, distinct before the graph is solved. Defined cases: a null key links nothing; a row without keys
    is a group of its own; rows repeated with one id are one vertex that has the keys of all of them; a null id gives no row.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("i"), *[F.col(f"`{k}`").alias(f"k{n}") for n, k in enumerate(keys)]).where("i IS NOT NULL")
    for n in range(len(keys)):
        rep = rows.where(f"k{n} IS NOT NULL").groupBy(f"k{n}").agg(F.min("i").alias(f"r{n}"))
        rows = rows.join(rep, f"k{n}", "left").drop(f"k{n}")
    rows = stage(rows, "keyed")
    reps = [f"r{n}" for n in range(len(keys))]
    home = F.coalesce(*[F.col(r) for r in reps], F.col("i"))
    pairs = None
    for r in reps:
        p = rows.where(F.col(r).isNotNull()).select(home.alias("src"), F.col(r).alias("dst"))
        pairs = p if pairs is None else pairs.unionAll(p)
    # an id on several rows joins what they have
    many = rows.groupBy("i").agg(F.min(home).alias("src"), F.max(home).alias("dst"), F.count(F.lit(1)).alias("n")).where("n > 1")
    several = rows.join(many.select("i", F.col("src")), "i").select("src", home.alias("dst"))
    groups = group_links(pairs.unionAll(several).where("src <> dst").distinct(), id_col="h", group_col="g")
    one = rows.groupBy("i").agg(F.min(home).alias("h"))
    return one.join(groups, "h", "left").select(F.col("i").alias(id_col), F.coalesce("g", "h").alias(group_col))


@F.pandas_udf(StringType())
def _fold_unicode(s):
    import unicodedata

    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", x).casefold()))


def folded(c: Column) -> Column:
    """NFKC without case; texts of plain ASCII stay in the JVM, Python sees a null for them."""
    plain = c.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, F.lower(c)).otherwise(_fold_unicode(F.when(plain, F.lit(None)).otherwise(c)))


def says_something(c: Column) -> Column:
    return c.isNotNull() & ~F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")).isin(*NOTHING)
