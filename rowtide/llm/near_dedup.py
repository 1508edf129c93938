"""Near-duplicates by chosen-path set similarity join.

Texts with equal shingle sets form one class. Classes are spread over
independent trees by selected minwise tokens. Small nodes are compared
exhaustively; a member of a large node is compared with the node's leader, and
a large node whose members are not all connected yet branches again by further
minwise tokens. In crowded small nodes the most similar candidates come first;
if they don't connect the node, its full sets are compared in one task, which
reports a spanning forest of the links only. Every reported link is confirmed on
full shingle sets; the number of trees sets the recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import maybe_in, saved, text_parts, whole_text
from .components import components
from .shingles import SLICE_BYTES, mixed, shingle_sets, slices

#: Independent trees. A pair of similarity s meets at the root of one with probability s.
TREES = 10
#: Minwise tokens per set; a power of two.
TOKENS = 32
#: Most children per member and level of a large node. Two in a third of all
#: cases, else one: 4/3 on average, the least for which a pair of similarity
#: 0.75 is expected to stay together in one child.
BRANCHES = 2
#: Members, and shingles of all members (8 bytes each), of a node that is
#: compared exhaustively; larger nodes branch.
SMALL, SMALL_SHINGLES = 4096, 4 << 20
#: Candidates of a member beyond which its node counts as crowded.
PARTNERS = 4
#: Levels that branch by one series of tokens; further levels take fresh tokens from the full sets.
LEVELS = TOKENS // BRANCHES
#: Equal tokens that a candidate needs: pairs of similarity 0.75 have fewer with probability 1e-5.
LEAST_EQUAL = 13
#: Similarity of a link, in hundredths.
PERCENT = 75


def _hashes(series: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash functions of one series of tokens."""
    rng = np.random.Generator(np.random.PCG64([PERCENT, series]))
    flip = rng.integers(0, 2**63, TOKENS, dtype=np.uint64)
    return flip, rng.integers(0, 2**63, TOKENS, dtype=np.uint64) | np.uint64(1)


def _minwise(values: np.ndarray, at: np.ndarray, series: int) -> np.ndarray:
    """The minwise tokens of sets that begin at ``at``; none of them is empty."""
    flip, times = _hashes(series)
    tokens = [np.minimum.reduceat((values ^ f) * t, at).astype(np.int64) for f, t in zip(flip, times)]
    return np.stack(tokens, 1)


def _signed(texts: list[bytes]) -> tuple[list[int], list[bytes | None], np.ndarray]:
    """Set sizes, digests of the sets (None if empty), and minwise tokens."""
    sets = shingle_sets(texts)
    sizes = [len(s) for s in sets]
    full = [s for s in sets if len(s)]
    tokens = np.zeros((len(sets), TOKENS), np.int64)
    digests: list[bytes | None] = [None] * len(sets)
    if full:
        values = np.concatenate(full)
        at = np.concatenate([[0], np.cumsum([len(s) for s in full])])[:-1]
        rows = np.flatnonzero(sizes)
        tokens[rows] = _minwise(values, at, 0)
        sums = [np.add.reduceat(mixed(values ^ np.uint64(k)), at) for k in (1, 2)]
        for row, a, b in zip(rows, *sums):
            digests[row] = a.tobytes() + b.tobytes()
    return sizes, digests, tokens


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the shingle set, tokens, and sketch: the
    set's size and one byte per token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, "text", SLICE_BYTES):
                sizes, digests, tokens = _signed(part.column("text").to_pylist())
                flat = pa.array(tokens.ravel(), pa.int64())
                at = pa.array(np.arange(0, len(sizes) + 1, dtype=np.int32) * TOKENS)
                low = (tokens & 255).astype(np.uint8)
                sketches = [n.to_bytes(4, "little") + row.tobytes() for n, row in zip(sizes, low)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(at, flat),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "digest", "tokens", "sketch"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().cast("binary").alias("text"))
    return texts.mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, tokens array<long>, sketch binary"
    )


def full_sets(docs: DataFrame) -> DataFrame:
    """rep (the doc_id) and ``items``, the whole shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, "text", SLICE_BYTES):
                sets = shingle_sets(part.column("text").to_pylist())
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                items = pa.array(np.concatenate(sets).astype(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), pa.ListArray.from_arrays(pa.array(at), items)],
                    names=["rep", "items"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), whole_text().cast("binary").alias("text"))
    return texts.mapInArrow(run, "rep long, items array<long>")


def _fresh_tokens(sets: DataFrame, series: int) -> DataFrame:
    """rep and the tokens of a further series, from the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("items")
            bounds = lists.offsets.to_numpy()
            for part in slices((8 * np.diff(bounds)).tolist()):
                start, stop = bounds[part.start], bounds[part.stop]
                values = lists.values[start:stop].to_numpy().view(np.uint64)
                tokens = _minwise(values, bounds[part.start : part.stop] - start, series)
                at = pa.array(np.arange(0, len(tokens) + 1, dtype=np.int32) * TOKENS)
                reps = batch.column("rep")[part.start : part.stop]
                lists_of_tokens = pa.ListArray.from_arrays(at, pa.array(tokens.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([reps, lists_of_tokens], names=["rep", "tokens"])

    return sets.select("rep", "items").mapInArrow(run, "rep long, tokens array<long>")


def _alike(sketch: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which pairs of sketches may be similar enough."""
    n, m = (x[..., :4].copy().view(np.uint32)[..., 0].astype(np.int64) for x in (sketch, others))
    close = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    return close & ((sketch[..., 4:] == others[..., 4:]).sum(-1) >= LEAST_EQUAL)


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, TOKENS + 4)


def _pairs(a: np.ndarray, b: np.ndarray, more: list[int] = ()) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    none = pa.nulls(len(more), pa.int64())
    columns = [pa.concat_arrays([pa.array(pairs[:, k].copy(), pa.int64()), none]) for k in (0, 1)]
    columns.append(pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(list(more), pa.int64())]))
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "more"])


def _small_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates (a, b) of small nodes, the best few of each member, and as
    ``more`` the nodes that have others."""
    for batch in batches:
        one, two, more = [], [], []
        members = batch.column("members")
        at = members.offsets.to_numpy()
        reps = members.values.field("rep").to_numpy()
        sketches = _rows(members.values.field("sketch"))
        for node, s, e in zip(batch.column("node").to_pylist(), at[:-1], at[1:]):
            own, sketch = reps[s:e], sketches[s:e]
            if e - s <= 2 * PARTNERS:
                i, j = np.triu_indices(e - s, 1)
                ok = _alike(sketch[i], sketch[j])
                one.append(own[i[ok]])
                two.append(own[j[ok]])
                continue
            crowded = False
            for i in range(e - s):
                alike = _alike(sketch[i], sketch)
                alike[i] = False
                found = np.flatnonzero(alike)
                if len(found) > PARTNERS:
                    equal = (sketch[found, 4:] == sketch[i, 4:]).sum(-1)
                    found = found[np.argsort(-equal, kind="stable")[:PARTNERS]]
                    crowded = True
                one.append(np.full(len(found), own[i]))
                two.append(own[found])
            if crowded:
                more.append(node)
        if one:
            yield _pairs(np.concatenate(one), np.concatenate(two), more)


def _spanning_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares all members of each node on their full sets; the links (a, b)
    that connect members whose labels were not connected before."""
    for batch in batches:
        members = batch.column("members")
        bounds = members.offsets.to_numpy()
        fields = members.values
        reps, labels = (fields.field(c).to_numpy() for c in ("rep", "label"))
        lists = fields.field("items")
        starts, items = lists.offsets.to_numpy(), lists.values.to_numpy()
        links = []
        for s, e in zip(bounds[:-1], bounds[1:]):
            known, ids = np.unique(items[starts[s] : starts[e]], return_inverse=True)
            at = starts[s : e + 1] - starts[s]
            sizes = np.diff(at)
            label = labels[s:e].copy()
            seen = np.zeros(len(known), np.int64)
            for i in range(e - s):
                seen[ids[at[i] : at[i + 1]]] = 1
                both = np.add.reduceat(seen[ids], at[:-1])
                seen[ids[at[i] : at[i + 1]]] = 0
                near = 100 * both >= PERCENT * (sizes + sizes[i] - both)
                for j in np.flatnonzero(near & (label != label[i])):
                    if label[j] != label[i]:
                        links.append((reps[s + i], reps[s + j]))
                        label[label == label[j]] = label[i]
        if links:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )


def _leader_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            ok = _alike(_rows(batch.column("sketch")), _rows(batch.column("leader_sketch")))
            yield _pairs(
                *(batch.column(c).to_numpy().astype(np.int64)[ok] for c in ("rep", "leader"))
            )


def _nodes(members: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """Members (node, root, rep, n, sketch) of nodes with at least two, with
    each node's leader, and whether it is small. Most nodes have one member, so
    sketches join what is left. The joins are merged at every size: their sides
    grow with the classes."""
    small = (F.count(F.lit(1)) <= SMALL) & (F.sum("n") <= SMALL_SHINGLES)
    sizes = (
        members.groupBy("node")
        .agg(F.count(F.lit(1)).alias("size"), small.alias("small"), F.min("rep").alias("leader"))
        .where("size > 1")
        .select("node", "small", "leader")
    )
    if "root" not in members.columns:
        members = members.withColumn("root", F.col("node"))
    sketches = classes.select("rep", "sketch").hint("merge")
    return saved(members.join(sizes.hint("merge"), "node").join(sketches, "rep"), name)


def _candidates(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    small = (
        nodes.where("small")
        .groupBy("node")
        .agg(F.collect_list(F.struct("rep", "sketch")).alias("members"))
        .mapInArrow(_small_pairs, "a long, b long, more long")
    )
    return small.unionByName(_to_leaders(nodes, classes)).distinct()


def _to_leaders(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    large = nodes.where("NOT small")
    # One row per large node.
    leaders = (
        large.where("rep = leader")
        .select("node", "leader")
        .join(classes.select(F.col("rep").alias("leader"), F.col("sketch").alias("leader_sketch")), "leader")
    )
    return (
        large.where("rep <> leader")
        .select("node", "rep", "sketch")
        .join(leaders, "node")
        .select("rep", "sketch", "leader", "leader_sketch")
        .mapInArrow(_leader_pairs, "a long, b long, more long")
    )


def _compared(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of small nodes (node, rep, label), from their full sets."""
    return (
        nodes.select("node", "rep", "label")
        .join(maybe_in(sets, "rep", nodes.select("rep")).hint("merge"), "rep")
        .groupBy("node")
        .agg(F.collect_list(F.struct("rep", "label", "items")).alias("members"))
        .select("members")
        .mapInArrow(_spanning_links, "a long, b long")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough. Each pair takes the set of
    its greater member first: where many have the same leader, their sets are
    what the second join splits."""
    one = sets.select(F.col("rep").alias("a"), F.col("items").alias("items_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("items").alias("items_b"))
    both = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - both
    both_sets = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a")
    return both_sets.where(100 * both >= PERCENT * union).select("a", "b")


def _children(large: DataFrame, classes: DataFrame, sets: DataFrame, level: int) -> DataFrame:
    """The next level's members of large nodes: branches by tokens that their
    tree has not used, of a fresh series whenever one is used up."""
    series, level = divmod(level - 1, LEVELS)
    step = F.pmod(F.shiftright("root", 8), F.lit(TOKENS // 2)) * 2 + 1
    second = F.pmod(F.shiftright("root", 16) + level + 1, F.lit(3)) == 0
    first = level * BRANCHES
    places = F.when(second, F.array(F.lit(first), F.lit(first + 1))).otherwise(F.array(F.lit(first)))
    large = large.select("node", "root", "rep", "n")
    if series:
        members = saved(large.select("rep").distinct(), "needed")
        chosen = maybe_in(sets, "rep", members).join(members, "rep", "left_semi")
        tokens = saved(_fresh_tokens(chosen, series), "tokens")
    else:
        tokens = classes.select("rep", "tokens")
    return (
        large.join(tokens, "rep")
        .withColumn("nr", F.explode(places))
        .withColumn("place", F.pmod(F.col("root") + F.col("nr") * step, F.lit(TOKENS)).cast("int"))
        .select(F.xxhash64("node", "place", F.get("tokens", F.col("place"))).alias("node"), "root", "rep", "n")
    )


def _labels(links: DataFrame) -> DataFrame:
    """(rep, component) of all that have links."""
    return saved(components(links).select(F.col("vertex").alias("rep"), "component"), "labels")


def _unsettled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The nodes whose members (with their ``label``) are not all connected."""
    labelled = nodes.join(labels, "rep", "left").withColumn("label", F.coalesce("component", "rep"))
    labelled = saved(labelled.drop("component"), "labelled")
    apart = labelled.groupBy("node").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    apart = apart.where("low <> high").select("node")
    return saved(labelled.join(apart, "node", "left_semi"), "unsettled")


def linked_classes(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """The classes of equal sets (digest, rep), each with its component."""
    classes = saved(
        signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n"),
            F.first("tokens").alias("tokens"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    trees = F.posexplode(F.slice("tokens", 1, TREES)).alias("tree", "token")
    roots = classes.select("rep", "n", trees)
    roots = roots.select(F.xxhash64("tree", "token").alias("node"), "rep", "n")
    nodes = _nodes(roots, classes, "nodes")
    found = saved(_candidates(nodes, classes), "candidates")
    pairs = found.where("more IS NULL").select("a", "b")
    crowded = found.where("more IS NOT NULL").select(F.col("more").alias("node"))
    # Nodes that may have links beyond these candidates.
    open_nodes = nodes.where("NOT small").unionByName(nodes.where("small").join(crowded, "node", "left_semi"))
    needed = [pairs.select(F.col(c).alias("doc_id")) for c in ("a", "b")]
    needed = needed[0].unionByName(needed[1]).unionByName(open_nodes.select(F.col("rep").alias("doc_id")))
    needed = saved(needed.distinct(), "needed")
    # Only texts that are probably needed are shuffled for the exact join.
    texts = maybe_in(docs.select("doc_id", "text"), "doc_id", needed)
    sets = saved(full_sets(texts.join(needed.hint("merge"), "doc_id", "left_semi")), "sets")
    labels = _labels(saved(_confirmed(pairs, sets), "links"))
    level = 0
    while True:
        open_nodes = _unsettled(open_nodes, labels)
        if open_nodes.isEmpty():
            return classes.select("digest", "rep").join(labels, "rep", "left")
        new = saved(_compared(open_nodes.where("small"), sets), "links")
        large = open_nodes.where("NOT small")
        if large.isEmpty():
            open_nodes = large  # all links are known
        else:
            level += 1
            open_nodes = _nodes(_children(large, classes, sets, level), classes, "nodes")
            pairs = saved(_to_leaders(open_nodes, classes).select("a", "b").distinct(), "candidates")
            paired = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
            new = new.unionByName(saved(_confirmed(pairs, maybe_in(sets, "rep", paired)), "links"))
        if not new.isEmpty():
            labels = _labels(labels.select(F.col("rep").alias("a"), F.col("component").alias("b")).unionByName(new))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id, kept.

    Texts are lower-cased (A-Z) and split into words at ASCII white space; a
    null or empty text, or one of white space, has an empty set and links with
    nothing. component_id is the smallest doc_id reachable over links of
    similarity 0.75 or more; kept is doc_id = component_id. Rows that repeat a
    doc_id are one vertex. A row with a null doc_id is returned unlinked, kept,
    with a null component_id. Other columns are ignored.
    """
    signed = saved(signatures(docs), "signatures")
    labelled = linked_classes(docs, signed)
    labelled = labelled.select("digest", F.coalesce("component", "rep").alias("component_id"))
    linked = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "n_shingles", "digest")
    alone = signed.where("digest IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles")
    return (
        linked.join(labelled, "digest")
        .select("doc_id", "n_shingles", "component_id")
        .unionByName(alone.withColumn("component_id", F.col("doc_id")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are their component's smallest doc_id, or have
    no doc_id, with all their columns."""
    # Written first: of a known size, Spark broadcasts it where it is small.
    dropped = saved(near_duplicates(docs).where("NOT kept").select("doc_id").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
