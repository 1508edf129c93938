"""Exact top-k inner products by best-first search in an M-tree.

Vectors become integers. One more coordinate, sqrt(M - |x|^2) with M the
largest squared norm, turns the largest inner product into the least distance.
The tree's upper level are pivots; below a pivot lie pages of bounded size,
each with routing objects, covering radii and the distances of all entries to
their parents. A page is one row, so Spark spreads pages over tasks. A query
first searches a page of its own pivot, which gives its bound; then blocks of
queries meet all pages and skip what the triangle inequality excludes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Pivots of the upper level, from a sample; and entries per page, about.
PIVOTS, PAGE = 64, 2048
#: Queries per block.
BLOCK = 256
#: Numbers are multiplied by this and rounded down.
SCALE = 256
#: Groups of nodes whose entries are compared at once.
NODES_AT_ONCE = 8
#: Allowance for rounding in distances; and in products, as a share of the
#: largest squared norm.
SLACK, ROUNDING = 1e-6, 1e-8
#: Largest squared norm up to which products of doubles are exact.
EXACT = 2**53


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and v (integers) of the vectors that take part: without null or
    non-finite components, not empty, with an id, and of the most frequent length."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    peak = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine)
    peak = peak.agg(F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))).first()[0] or 0
    if SCALE * peak >= 2**63:
        raise ValueError(f"components up to {peak:g} give inner products beyond 64 bits")
    kind = "int" if SCALE * peak < 2**30 else "long"
    numbers = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast(kind))
    found = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine)
    found = found.select(F.col("vec_id").cast("long"), numbers.alias("v")).where(F.size("v") > 0)
    found = saved(found, "vectors")
    usual = found.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.where(F.size("v") == (usual.n if usual else 0))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(rows, -1)


def _number(largest: float) -> type:
    """What components are kept as: small ones are multiplied as doubles."""
    return np.int32 if largest < EXACT else np.int64


def _raised(v: np.ndarray, largest: float) -> np.ndarray:
    last = np.sqrt(np.maximum(largest - (v * v).sum(1), 0))
    return np.hstack([v, last[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _placed(vectors: DataFrame, pivots: np.ndarray, largest: float) -> DataFrame:
    """vec_id, v and the nearest pivot of each vector."""
    kind = vectors.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _raised(_matrix(batch.column("v"), batch.num_rows), largest)
                nearest = _distances(x, pivots).argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(nearest, pa.int32())], names=["vec_id", "v", "pivot"]
                )

    return vectors.mapInArrow(run, f"vec_id long, v {kind}, pivot int")


def _built(batches: Iterator[pa.RecordBatch], largest: float) -> Iterator[pa.RecordBatch]:
    """A page from the vectors of each row: entries ordered by node, with routing
    objects, covering radii, and distances to the parents."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            entries = sorted(row["entries"], key=lambda e: e["vec_id"])
            ids = np.array([e["vec_id"] for e in entries])
            v = np.array([e["v"] for e in entries], _number(largest))
            x = _raised(v.astype(np.float64), largest)
            n = max(1, int(len(x) ** 0.5))
            routers = [0]
            gap = _distances(x, x[:1])[:, 0]
            while len(routers) < n and gap.max() > 0:
                routers.append(int(gap.argmax()))
                gap = np.minimum(gap, _distances(x, x[routers[-1:]])[:, 0])
            to_parent = _distances(x, x[routers])
            node = to_parent.argmin(1)
            order = np.argsort(node, kind="stable")
            own = to_parent[order, node[order]]
            ends = np.searchsorted(node[order], np.arange(len(routers) + 1))
            radius = np.array([own[a:b].max(initial=0) for a, b in zip(ends[:-1], ends[1:])])
            top = _distances(x[routers], x[:1])[:, 0]
            rows.append(
                {
                    "pivot": row["pivot"],
                    "page": row["page"],
                    "ids": ids[order].tolist(),
                    "v": v[order].tobytes(),
                    "to_parent": own.tobytes(),
                    "ends": ends.astype(np.int64).tobytes(),
                    "routers": x[routers].tobytes(),
                    "radius": radius.tobytes(),
                    "to_top": top.tobytes(),
                    "cover": float((top + radius).max()),
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=_PAGE)


_PAGE = pa.schema(
    [("pivot", pa.int32()), ("page", pa.int64()), ("ids", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("v", "to_parent", "ends", "routers", "radius", "to_top")]
    + [("cover", pa.float64())]
)
_PAGE_SQL = (
    "pivot int, page long, ids array<long>, v binary, to_parent binary, ends binary, "
    "routers binary, radius binary, to_top binary, cover double"
)


def _search(page: dict, queries: list[dict], k: int, largest: float) -> list[tuple[int, int, int, int, int]]:
    """The page's rows that may be among the k best of each query, given its bound,
    as (query_id, nr, times, vec_id, score)."""
    ids = np.array(page["ids"])
    exact = np.float64 if largest < EXACT else np.int64
    v = np.frombuffer(page["v"], _number(largest)).reshape(len(ids), -1).astype(exact)
    to_parent, radius, to_top = (np.frombuffer(page[c], np.float64) for c in ("to_parent", "radius", "to_top"))
    ends = np.frombuffer(page["ends"], np.int64)
    routers = np.frombuffer(page["routers"], np.float64).reshape(len(radius), -1)
    factors = np.array([r["v"] for r in queries], exact)
    q = factors.astype(np.float64)
    norm = (q * q).sum(1)
    raised = np.hstack([q, np.zeros((len(q), 1))])
    top = _distances(raised, routers[:1])[:, 0]
    found = []

    def best(distance: np.ndarray, square: float) -> np.ndarray:
        """The largest inner product at such a distance or more."""
        near = np.maximum(distance * (1 - SLACK) - SLACK, 0)
        return (square + largest - near * near) / 2 + ROUNDING * largest

    for i, query in enumerate(queries):
        bound = -np.inf if query["bound"] is None else query["bound"]
        if best(top[i : i + 1] - page["cover"], norm[i])[0] < bound:
            continue
        # Stored distances first: they cost no new one.
        open_nodes = np.flatnonzero(best(np.abs(top[i] - to_top) - radius, norm[i]) >= bound)
        if not len(open_nodes):
            continue
        to_router = _distances(raised[i : i + 1], routers[open_nodes])[0]
        hope = best(to_router - radius[open_nodes], norm[i])
        order = np.argsort(-hope, kind="stable")
        scores, owners = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(order), NODES_AT_ONCE):
            some = order[at : at + NODES_AT_ONCE]
            some = some[hope[some] >= bound]
            if not len(some):
                break
            nodes = open_nodes[some]
            rows = np.concatenate([np.arange(ends[n], ends[n + 1]) for n in nodes])
            far = np.abs(np.repeat(to_router[some], ends[nodes + 1] - ends[nodes]) - to_parent[rows])
            rows = rows[(best(far, norm[i]) >= bound) & (ids[rows] != query["vec_id"])]
            scores = np.concatenate([scores, (v[rows] @ factors[i]).astype(np.int64)])
            owners = np.concatenate([owners, ids[rows]])
            keep = np.lexsort([owners, -scores])[:k]
            scores, owners = scores[keep], owners[keep]
            if len(scores) == k:
                bound = max(bound, scores[-1])
        fine = scores >= bound if query["bound"] is not None else scores == scores
        asked = query["vec_id"], query["nr"], query["times"]
        found += [(*asked, int(o), int(s)) for o, s in zip(owners[fine], scores[fine])]
    return found


def _searched(pairs: DataFrame, k: int, largest: float) -> DataFrame:
    """query_id, nr, times, vec_id, score from rows that hold a page and ``queries``."""
    names = ["query_id", "nr", "times", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                hits = _search(row, row["queries"], k, largest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h[c] for h in hits], pa.int64()) for c in range(5)], names=names
                )

    return pairs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _met(tree: DataFrame, blocks: DataFrame, rows: int, queries: int, tasks: int) -> DataFrame:
    """Each page with each row of ``blocks`` (block, queries) once, in about ``tasks`` tasks.

    Tasks form a grid: pages are dealt to slots and go to each group of blocks,
    blocks are dealt to groups and go to each slot. Groups are as many as make
    copies fewest. Blocks are never broadcast: Spark's estimate of their size
    leaves out the copies, so the driver would hold all of them.
    """
    groups = max(1, min(blocks.count(), round((tasks * queries / max(1, rows)) ** 0.5)))
    slots = max(1, -(-tasks // groups))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    pages = tree.withColumn("slot", F.pmod(F.xxhash64("pivot", "page"), F.lit(slots)).cast("int"))
    dealt = blocks.select("queries", F.pmod("block", F.lit(groups)).cast("int").alias("group"), each(slots).alias("slot"))
    return pages.withColumn("group", each(groups)).join(dealt.hint("merge"), ["slot", "group"])


def _best(hits: DataFrame, k: int, *of: str) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_inner_products(vectors: DataFrame, queries: str, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector for which the condition
    ``queries`` on vec_id holds, the k other vectors of highest inner product,
    ties to the smaller vec_id; fewer where there are fewer.

    Vectors with a null id, null or non-finite components, or another length
    than most take no part. Rows that repeat a vec_id are rows of their own,
    none of which is a partner of the others: a partner stored twice takes two
    ranks, and so does each partner of a query stored twice. No vectors give no
    rows; where an inner product could leave 64 bits, an error is raised.
    """
    found = quantised(vectors)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    largest = float(found.agg(F.max(square)).first()[0] or 0)
    if largest >= 2**63:
        raise ValueError(f"squared norms up to {largest:g} give inner products beyond 64 bits")
    # A bounded sample of rows, the same in each run.
    sample = found.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    empty = "query_id long, rank int, vec_id long, score long"
    if not sample:
        return vectors.sparkSession.createDataFrame([], empty)
    pivots = _raised(np.array([r.v for r in sample], np.float64), largest)
    # The number of a row spreads rows that repeat a vec_id over pages.
    placed = _placed(found, pivots, largest).withColumn("row", F.monotonically_increasing_id())
    placed = saved(placed, "placed")
    sizes = placed.groupBy("pivot").count()
    # One row per pivot.
    paged = placed.join(F.broadcast(sizes), "pivot")
    pages = F.pmod(F.xxhash64("vec_id", "row"), F.ceil(F.col("count") / PAGE))
    paged = paged.select("pivot", pages.cast("long").alias("page"), "vec_id", "v")
    built = (
        paged.groupBy("pivot", "page")
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("entries"))
        .mapInArrow(lambda batches: _built(batches, largest), _PAGE_SQL)
    )
    tree = saved(built, "tree")
    # Each distinct query once, with a number among those of its vec_id.
    asked = placed.where(queries).groupBy("pivot", "vec_id", "v").agg(F.count(F.lit(1)).alias("times"))
    number = F.row_number().over(Window.partitionBy("vec_id").orderBy("v"))
    asked = saved(asked.withColumn("nr", number.cast("long")), "asked")
    query = ["vec_id", "nr", "times", "v"]
    own = asked.withColumn("bound", F.lit(None).cast("long")).withColumn("block", F.pmod(F.xxhash64("vec_id", "nr"), F.lit(8)))
    own = own.groupBy("pivot", "block").agg(F.collect_list(F.struct(*query, "bound")).alias("queries"))
    first = saved(_searched(tree.where("page = 0").join(own, "pivot"), k, largest), "first")
    bounds = _best(first, k, "query_id", "nr").groupBy("query_id", "nr")
    bounds = bounds.agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    bounds = bounds.select(F.col("query_id").alias("vec_id"), "nr", "bound")
    asked = asked.select(*query).join(bounds, ["vec_id", "nr"], "left")
    count = asked.count()
    blocks = asked.groupBy(F.pmod(F.xxhash64("vec_id", "nr"), F.lit(max(1, -(-count // BLOCK)))).alias("block"))
    blocks = saved(blocks.agg(F.collect_list(F.struct(*query, "bound")).alias("queries")), "blocks")
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # All pages are searched here, the first ones again, so each row is met once.
    pairs = _met(tree, blocks, placed.count(), count, tasks)
    hits = _best(_searched(pairs, k, largest), k, "query_id", "nr").drop("rank")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k))))
    hits = hits.select("query_id", "vec_id", "score", copies.alias("copy"))
    return _best(hits, k, "query_id").select("query_id", F.col("rank").cast("int"), "vec_id", "score")
