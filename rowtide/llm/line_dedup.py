"""Line deduplication by pairwise alignment.

Documents that share the hash of a long line are aligned: each with the line's
first holder, and for rare lines also with the holder just before. So are those
that share a run of adjacent lines which just reaches the words of a block, each
with the run's first holder; every block that may go consists of such runs.
Patience diff finds the blocks of lines that both have in the same order, and
the hashes of runs those that it has no anchor for; the later document (larger
doc_id) loses those that are long enough. Pairs grow with the lines, never with the square of a line's holders, and the first holder of a
line always keeps it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, whole_text

#: A line with fewer words links no documents.
LINK_WORDS = 5
#: Words of a block that is deleted, at least.
BLOCK_WORDS = 10
#: A line that at most so many documents hold is rare.
RARE = 16
#: Parts into which the holders of a line or run, and the partners of a document, are divided.
SALTS = 64
#: Modulus and base of the hashes of runs.
PRIME, BASE = 2**61 - 1, 1_000_003_000_007


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions of equal lines in both, in order, by patience diff."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if once_b[b[j]] == 1}
        unique = [(i, place[a[i]]) for i in range(a0, a1) if once_a[a[i]] == 1 and a[i] in place]
        # Longest rising sequence of the places in b.
        tops: list[int] = []
        at: list[int] = []
        before: list[int] = []
        for n, (_, j) in enumerate(unique):
            k = bisect_left(tops, j)
            before.append(at[k - 1] if k else -1)
            tops[k : k + 1] = [j]
            at[k : k + 1] = [n]
        n = at[-1] if at else -1
        chain = []
        while n >= 0:
            chain.append(unique[n])
            n = before[n]
        edges = [*reversed(chain)]
        if edges:
            starts = [(a0, b0), *edges]
            for (i, j), (k, m) in zip(starts, [*edges, (a1, b1)]):
                todo.append((i, k, j, m))
    return sorted(found)


def runs(lines: list[int], words: list[int]) -> list[tuple[int, int, int]]:
    """First line, end and hash of the shortest runs of adjacent lines with the
    words of a block that begin or end with each line. Together they cover every
    longer block but for lines without words at its ends."""
    found = set()
    start = end = total = 0
    for start, n in enumerate(words):  # the shortest from each line on
        while end < len(words) and total < BLOCK_WORDS:
            total += words[end]
            end += 1
        if total < BLOCK_WORDS:
            break
        if n:
            found.add((start, end))
        total -= n
    start = total = 0
    for end, n in enumerate(words, 1):  # the shortest up to each line
        total += n
        while total - words[start] >= BLOCK_WORDS:
            total -= words[start]
            start += 1
        if n and total >= BLOCK_WORDS:
            found.add((start, end))
    power, sums = [1], [0]
    for x in lines:
        power.append(power[-1] * BASE % PRIME)
        sums.append((sums[-1] * BASE + x) % PRIME)
    return [(i, j, (sums[j] - sums[i] * power[j - i]) % PRIME) for i, j in sorted(found)]


def common_blocks(later: list[int], earlier: list[int], words: list[int]) -> list[int]:
    """Lines of the later document in aligned blocks of enough words, and in runs
    of enough words that the alignment leaves: where lines repeat there may be no
    anchor, and a passage may stand in another order or once more."""
    gone, block, last = set(), [], None
    for i, j in [*aligned(later, earlier), (-9, -9)]:
        if last is not None and (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[x] for x in block) >= BLOCK_WORDS:
                gone.update(block)
            block = []
        block.append(i)
        last = (i, j)
    if len(gone) < len(later):
        known = dict(zip(later, words))
        # A line that the later document lacks is in no common run, whatever its words.
        held = {key for _, _, key in runs(earlier, [known.get(x, BLOCK_WORDS) for x in earlier])}
        done = 0
        for i, j, key in runs(later, words):
            if key in held:
                gone.update(range(max(i, done), j))
                done = max(done, j)
    return sorted(gone)


def _run_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = [], []
        for doc, lines, words in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lines", "words"))):
            own = {key for i, j, key in runs(lines, words) if j - i > 1}
            ids += [doc] * len(own)
            keys += own
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64())], names=["doc_id", "run"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("later", "lines", "words", "other")]
        ids, gone = [], []
        for later, lines, words, other in zip(*columns):
            found = common_blocks(lines, other, words)
            if found:
                ids.append(later)
                gone.append(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["doc_id", "gone"]
        )


def _with_firsts(held: DataFrame, key: str) -> DataFrame:
    """The rows (doc_id, key) whose key several documents hold, with the number
    ``n`` of holders and the smallest, ``first``.

    Holders are counted in parts of a key, so one that a third of all documents
    hold is no task's alone: each part is told the whole key's figures.
    """
    held = held.withColumn("salt", _salt("doc_id"))
    parts = held.groupBy(key, "salt").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    totals = parts.groupBy(key).agg(F.sum("n").alias("n"), F.min("first").alias("first")).where("n > 1")
    known = parts.select(key, "salt").join(totals.hint("merge"), key)
    return held.join(known.hint("merge"), [key, "salt"]).drop("salt")


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id and ``gone``, the sorted line numbers (from 0) to delete."""
    lines = F.split(whole_text(), "\n")
    words = F.transform("lines", lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + (x != "").cast("int"))
    hashed = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), lines.alias("lines"))
    hashed = hashed.select("doc_id", F.transform("lines", lambda x: F.xxhash64(x)).alias("lines"), words.alias("words"))
    hashed = saved(hashed, "lines")
    repeated = hashed.groupBy("doc_id").count().where("count > 1").select("doc_id")
    hashed = hashed.join(repeated, "doc_id", "left_anti")
    long_lines = F.filter(F.arrays_zip("lines", "words"), lambda x: x["words"] >= LINK_WORDS)
    long_lines = F.array_distinct(F.transform(long_lines, lambda x: x["lines"]))
    holders = saved(hashed.select("doc_id", F.explode(long_lines).alias("line")), "holders")
    shared = saved(_with_firsts(holders, "line"), "shared")
    to_first = shared.where("doc_id <> first").select(F.col("doc_id").alias("later"), F.col("first").alias("earlier"))
    before = F.lag("doc_id").over(Window.partitionBy("line").orderBy("doc_id"))
    to_last = shared.where(F.col("n") <= RARE).select(F.col("doc_id").alias("later"), before.alias("earlier"))
    # Runs of one line are among the lines above.
    short = hashed.where(F.exists("words", lambda x: x.between(1, BLOCK_WORDS - 1))).select("doc_id", "lines", "words")
    held = saved(short.mapInArrow(_run_holders, "doc_id long, run long"), "runs")
    by_runs = _with_firsts(held, "run").where("doc_id <> first")
    by_runs = by_runs.select(F.col("doc_id").alias("later"), F.col("first").alias("earlier"))
    pairs = to_first.unionByName(to_last.where("earlier IS NOT NULL")).unionByName(by_runs).distinct()
    later = hashed.withColumnRenamed("doc_id", "later")
    # The first holder of a common line has many partners: each part of them gets its own copy of its lines.
    pairs = saved(pairs.withColumn("salt", _salt("later")), "pairs")
    earlier = hashed.select(F.col("doc_id").alias("earlier"), F.col("lines").alias("other"))
    earlier = pairs.select("earlier", "salt").distinct().join(earlier.hint("merge"), "earlier")
    both = pairs.join(earlier.hint("merge"), ["earlier", "salt"]).select("later", "other")
    both = both.join(later.hint("merge"), "later")
    gone = both.mapInArrow(_removed, "doc_id long, gone array<int>")
    gone = gone.select("doc_id", F.explode("gone").alias("line")).groupBy("doc_id")
    return gone.agg(F.array_sort(F.collect_set("line")).alias("gone"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` (doc_id, text): doc_id, text without the deleted
    lines, n_lines, gone (numbers of the deleted lines, from 0).

    A text splits at line feeds. Null and empty texts are one empty line and
    lose nothing; a null text becomes empty. A copy of an earlier text loses all its lines and
    becomes empty. Rows with a null or repeated doc_id are left as they are.
    Other columns are ignored.
    """
    gone = saved(removed_lines(docs), "gone")
    text = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    lines = F.split("text", "\n")
    places = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.col("gone"), i))
    # Merged at every size: the lines that go grow with the texts.
    return text.join(gone.hint("merge"), "doc_id", "left").select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        places.alias("gone"),
    )
