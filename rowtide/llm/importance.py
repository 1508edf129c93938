"""Importance resampling of documents towards a target set, over hashed word n-grams.

Features are runs of one to three words. A feature's bucket is the CRC-32 of its
bytes modulo a number of buckets. A batch's distinct features are grouped by
length into matrices of bytes, and the CRCs of a matrix grow column by column;
the buckets are then scattered back to where the features occur. A bucket's gain
compares its smoothed share in the target with that in the corpus, a document's
weight is the sum of its features' gains, and the documents of highest weight
plus Gumbel noise are drawn.

Nothing but the counts of the buckets passes the driver. The drawn documents are
ranked in ranges of the score, each in a task of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, text_parts, whole_text

#: Buckets of features; also the number of gains that pass the driver.
BUCKETS = 10_000
#: Words in the longest feature.
LONGEST = 3
#: Documents of fewer words are not drawn.
LEAST_WORDS = 20
#: Share of those documents that is drawn, in percent.
SHARE = 5
SEED = 42
#: Words of a text that are hashed together.
CHUNK_WORDS = 1 << 17
#: Longer features get their CRC one by one, from zlib; the result is the same.
MATRIX_LENGTH = 256
#: Rows of drawn documents that a task ranks, about.
RANGE_ROWS = 500_000

_BYTES = np.arange(256)
_LOWERED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Digits, letters, and every byte of a character beyond ASCII.
_IN_WORD = ((_LOWERED >= 97) & (_LOWERED <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57)) | (_BYTES >= 128)


@lru_cache(1)
def crc_steps() -> np.ndarray:
    """What each byte adds to a CRC-32, by the reversed polynomial 0xEDB88320."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps


def crc_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a matrix of bytes, all rows at once, column by column."""
    steps = crc_steps()
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = steps[(crc ^ column) & 255] ^ (crc >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def crc_slices(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice of ``raw``: slices of one length make one matrix."""
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, cuts):
        if not len(rows):
            continue
        length = int(lengths[rows[0]])
        if length > MATRIX_LENGTH:
            out[rows] = [zlib.crc32(raw[s : s + length]) for s in starts[rows]]
        else:
            out[rows] = crc_rows(np.lib.stride_tricks.sliding_window_view(raw, length)[starts[rows]])
    return out


class Words:
    """The words of several texts, lower-cased and joined by one space."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1
        keep = _IN_WORD[raw]
        # A text's last byte is followed by a line end, so each word ends at some gap.
        ends = np.flatnonzero(keep[:-1] & ~keep[1:]) + 1
        lowered = _LOWERED[raw]
        lowered[ends] = 32
        keep[ends] = True
        self.raw = lowered[keep]
        self.ends = np.flatnonzero(self.raw == 32)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]).astype(np.int64)[: len(self.ends)]
        self.text = np.searchsorted(stops, ends)
        self.counts = np.bincount(self.text, minlength=len(texts))

    def buckets(self, buckets: int, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, bucket) of all features, for some words at a time."""
        for first in range(0, len(self.ends), CHUNK_WORDS):
            yield self._chunk(first, min(first + CHUNK_WORDS, len(self.ends)), buckets, longest)

    def _chunk(self, first: int, stop: int, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Features that start at a word of [first, stop)."""
        last = min(stop + longest - 1, len(self.ends))
        words = self.raw[self.starts[first] : self.ends[last - 1]].tobytes().split(b" ")
        named = np.empty(len(words), object)
        named[:] = words
        word, known = pd.factorize(named)
        starts, ends, text = (a[first:last] for a in (self.starts, self.ends, self.text))
        run = word.astype(np.int64)
        at = np.arange(stop - first)
        texts, places, froms, lengths, distinct = [], [], [], [], 0
        for n in range(longest):
            # Runs of n + 1 words: those of n words that another word of the text follows.
            at = at[at + n < len(word)]
            at = at[text[at + n] == text[at]]
            if n:
                run, _ = pd.factorize(run[at] * len(known) + word[at + n])
            else:
                run = run[at]
            held = int(run.max()) + 1 if len(run) else 0
            example = np.zeros(held, np.int64)
            example[run[::-1]] = at[::-1]
            texts.append(text[at])
            places.append(run + distinct)
            froms.append(starts[example])
            lengths.append(ends[example + n] - starts[example])
            distinct += held
            spread = np.zeros(stop - first, np.int64)
            spread[at] = run
            run = spread
        crc = crc_slices(self.raw, np.concatenate(froms), np.concatenate(lengths))
        return np.concatenate(texts), (crc % buckets)[np.concatenate(places)]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n: how many features of all texts are in each bucket that holds any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_parts(batch, "text"):
                for _, found in Words(part.column("text").to_pylist()).buckets(buckets):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    texts = docs.select(whole_text().cast("binary").alias("text"))
    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 * ln(smoothed share in ``target`` / smoothed share in ``docs``)) of each bucket."""
    counted = (
        bucket_counts(docs, buckets)
        .select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
        .unionByName(bucket_counts(target, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
        .unionByName(docs.sparkSession.range(buckets).selectExpr("id AS bucket", "0L AS s", "0L AS t"))
        .groupBy("bucket")
        .agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    )
    # One row per bucket, whatever the size of the corpus.
    rows = sorted(counted.collect())
    in_docs, in_target = sum(r.s for r in rows), sum(r.t for r in rows)
    share = [(r.t + 1.0) * (in_docs + buckets) / ((r.s + 1.0) * (in_target + buckets)) for r in rows]
    return [int(g) for g in np.floor(1000 * np.log(share))]


def weighted(docs: DataFrame, gains: list[int]) -> DataFrame:
    """doc_id, n_words, n_features, and weight: the sum of the gains of a text's features."""
    gain = np.array(gains, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, "text"):
                words = Words(part.column("text").to_pylist())
                features = np.zeros(part.num_rows, np.int64)
                weight = np.zeros(part.num_rows, np.int64)
                for text, found in words.buckets(len(gain)):
                    features += np.bincount(text, minlength=len(features))
                    np.add.at(weight, text, gain[found])
                columns = [part.column("doc_id"), *map(pa.array, (words.counts.astype(np.int64), features, weight))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` (saved rows with doc_id, score and n_features) with rank: 1, 2, ...
    for the highest scores among eligible rows, null for rows that are not drawn.

    Rows below a score that less than one percent more than the drawn rows reach
    are set aside; the others are dealt out by ranges of their order, so no task
    holds them all. Equal scores rank by doc_id, nulls last, then by n_features.
    """
    near = 1 - percent / 100 - 0.001
    stats = scored.where(eligible).agg(F.count("*").alias("n"), F.percentile_approx("score", near, 10_000).alias("limit"))
    n, limit = stats.first()
    drawn = n * percent // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = eligible & (F.col("score") >= limit)
    reached = scored.where(high).count()
    if reached < drawn:  # the estimate was off: rank all
        high, reached = eligible, n
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    parts = max(1, reached // RANGE_ROWS + 1)
    ranges = saved(
        scored.where(high).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges"
    )
    before, offsets = 0, []
    for part, rows in sorted(ranges.groupBy("part").count().collect()):  # a row per range
        offsets.append((part, before))
        before += rows
    offset = F.broadcast(scored.sparkSession.createDataFrame(offsets, "part int, before long"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ordered = ranges.join(offset, "part").withColumn("rank", F.when(place <= drawn, place)).drop("part", "before")
    return ordered.unionByName(scored.where(~high).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = SHARE,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of each row of ``docs``.

    ``target`` is a table with a ``text``. Of the rows with at least
    ``least_words`` words, ``percent`` percent (rounded down) are drawn and
    ranked; the rank of the others is null. A null text has no words; null or
    repeated doc_ids stay, each row for itself, a null one hashed as an empty
    text. An empty target leaves smoothing alone. Columns other than doc_id and
    text are ignored.
    """
    gains = bucket_gains(docs, target, buckets)
    scored = weighted(docs, gains).select("*", (F.col("weight") + noise(seed)).alias("score"))
    scored = saved(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    return ranked(scored, F.col("n_words") >= least_words, percent).drop("row")
