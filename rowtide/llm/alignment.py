"""Alignment of two tokenizers' tokens of the same text.

Both tokenizers' tokens are intervals of the text's bytes. All tokens of some
texts are sorted by their start, and the running maximum of their ends is taken:
where a start reaches it, both tokenizers have ended a token there, and a new
group begins. Within a group, tokens whose intervals overlap are linked.

Links are weighed by how often their pair of ids is linked in the whole corpus.
Texts are taken in chunks: a chunk sends each of its distinct pairs once to the
pair's count and gets the count back once, however often it holds the pair.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .byte_bpe import TWO_SPACES, byte_characters
from .common import kept_by_worker, saved, text_parts, whole_text

#: Tokens of both tokenizers in a chunk, about; one text is never cut.
CHUNK_TOKENS = 1 << 19
#: Bytes of a group of rows in the files of chunks. Spark's reader may hold all of
#: a group's rows at once, a few times larger than on disk.
GROUP_BYTES = 16 << 20
#: Bits of a B id in the number of a pair.
B_BITS = 24
#: Bytes of text that are encoded together: the tokenizers' own objects take fifty times that.
TEXT_BYTES = 128 << 10
#: Words that a worker remembers, about 300 bytes each; beyond it, memory is cleared, results stay the same.
REMEMBERED = 100_000

TOKENS = "doc_id long, a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>, a_stops array<int>, b_stops array<int>"


class Sides:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        back = {c: b for b, c in enumerate(byte_characters())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for name, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(back[c] for c in name)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)

        # Where no piece holds a space after its start, B's tokens never cross one.
        self.apart = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def encoded(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both as 32-bit numbers, None where they do not spell space and text."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        found: list[tuple[bytes, bytes] | None] = []
        for text, a_ids, b_ids in zip(texts, a, b):
            whole = (" " + text).encode()
            same = (
                text
                and b"".join(map(self.a_bytes.__getitem__, a_ids)) == whole
                and b"".join(map(self.b_bytes.__getitem__, b_ids)) == whole
            )
            found.append((array("I", a_ids).tobytes(), array("I", b_ids).tobytes()) if same else None)
        return found

    def separate(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """``encoded`` of words without spaces: encoded as one text and cut where
        they end, or one by one if a side does not spell that text."""
        whole = self.encoded([" ".join(words)])[0] if words else None
        if whole is None:
            return self.encoded(words) if words else []
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        sides = []
        for ids, sizes in zip(whole, (self.a_sizes, self.b_sizes)):
            stops = 4 * np.searchsorted(np.cumsum(sizes[np.frombuffer(ids, np.uint32)]), ends, "right")
            sides.append([ids[i:j] for i, j in zip([0, *stops.tolist()], stops.tolist())])
        return list(zip(*sides))

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text, none where they do not spell space and text.

        Both tokenizers end a token before a single space between two other
        characters. Texts without other spaces are encoded word by word, and
        words are remembered.
        """
        if len(self.known) > REMEMBERED:
            self.known.clear()
        words = [t.split(" ") if self.apart and not TWO_SPACES.search(f" {t} ") else [] for t in texts]
        new = list({w for several in words for w in several if w not in self.known})
        self.known.update(zip(new, self.separate(new)))
        rest = iter(self.encoded([t for t, several in zip(texts, words) if not several]))
        found = []
        for several in words:
            each = [self.known[w] for w in several] or [next(rest)]
            sides = ([e[0] for e in each], [e[1] for e in each]) if None not in each else ([], [])
            found.append(tuple(np.frombuffer(b"".join(s), np.uint32) for s in sides))
        for w in new:
            if len(w) > 64:
                del self.known[w]
        return found


def _sides(a_path: str, b_path: str) -> Sides:
    return kept_by_worker(("alignment", a_path, b_path), lambda: Sides(a_path, b_path))


def coalesced(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B have ended where each group ends.

    Both are the ends of gapless tokens over the same bytes.
    """
    ends = np.concatenate([a_ends, b_ends])
    starts = np.concatenate([[0], a_ends[:-1], [0], b_ends[:-1]])[: len(ends)] if len(ends) else ends
    side = np.repeat(np.array([0, 1], np.int8), [len(a_ends), len(b_ends)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    last = np.append(starts[order][1:] >= reached[:-1], True)[: len(ends)]
    from_b = np.cumsum(side[order], dtype=np.int64)
    stops = np.flatnonzero(last)
    return stops + 1 - from_b[stops], from_b[stops]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in A and in B of all pairs of tokens whose bytes overlap."""
    a_starts = np.concatenate([[0], a_ends[:-1]])[: len(a_ends)]
    b_starts = np.concatenate([[0], b_ends[:-1]])[: len(b_ends)]
    first = np.searchsorted(b_ends, a_starts, "right")
    linked = np.searchsorted(b_starts, a_ends, "left") - first
    a_at = np.repeat(np.arange(len(a_ends)), linked)
    within = np.arange(len(a_at)) - np.repeat(np.cumsum(linked) - linked, linked)
    return a_at, first[a_at] + within


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and where each row's begin, and the end."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _aligned(
    batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, text_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Rows of ``aligned`` for doc_id and text, a few texts at a time."""
    names = [field.split()[0] for field in TOKENS.split(", ")]
    sides = _sides(a_path, b_path)
    for batch in batches:
        for part in text_parts(batch, "text", text_bytes):
            found = sides.tokens(part.column("text").to_pylist())
            columns = [part.column("doc_id")]
            ends = []
            for side, sizes in ((0, sides.a_sizes), (1, sides.b_sizes)):
                offsets = np.concatenate([[0], np.cumsum([len(f[side]) for f in found])]).astype(np.int64)
                ids = np.concatenate([f[side] for f in found]).astype(np.int64)
                end = np.cumsum(sizes[ids])
                ends.append((end, offsets))
                before = np.concatenate([[0], end])[offsets[:-1]]
                columns += [_lists(ids, offsets), _lists(end - np.repeat(before, np.diff(offsets)), offsets)]
            # The rows' bytes follow each other on both sides, so no group spans two rows.
            stops = coalesced(ends[0][0], ends[1][0])
            rows = np.searchsorted(stops[0], ends[0][1], "right")
            for s, (_, offsets) in zip(stops, ends):
                columns.append(_lists(s - np.repeat(offsets[:-1], np.diff(rows)), rows))
            yield pa.RecordBatch.from_arrays(columns, names=names)


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Both tokenizers' tokens of each text and their groups, one row per row.

    ``a_path`` is a tokenizers file of a byte-level vocabulary, given space and
    text; ``b_path`` a sentencepiece model, given the text, to which it adds the
    space. ``a_ids`` and ``b_ids`` are the tokens, ``a_ends`` and ``b_ends`` the
    bytes of space and text where they end, ``a_stops`` and ``b_stops`` how many
    tokens have ended where each group ends. Null and empty texts, and those
    that a side does not spell (it changes characters), have no tokens. doc_id
    may be null or repeat; other columns are ignored. A text is taken whole; its
    tokens must fit in a task.
    """

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return texts.mapInArrow(lambda batches: _aligned(batches, a_path, b_path, TEXT_BYTES), TOKENS)


@lru_cache(1)
def _names() -> dict[bytes, np.ndarray]:
    """Decimal ids followed by each sign, as far as ids have been met."""
    return {sign: np.zeros(0, object) for sign in (b",", b"|", b";")}


def _named(ids: np.ndarray, sign: bytes) -> np.ndarray:
    known = _names()
    size = int(ids.max()) + 1 if len(ids) else 0
    if len(known[sign]) < size:
        size = 1 << size.bit_length()
        names = np.empty(size, object)
        names[:] = [b"%d%s" % (i, sign) for i in range(size)]
        known[sign] = names
    return known[sign][ids]


class _Rows:
    """Rows of ``aligned`` that one batch brought, as arrays over all of them."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids, self.ends, self.offsets, self.stops = [], [], [], []
        for side in "ab":
            ids, offsets = _flat(batch.column(f"{side}_ids"))
            ends, _ = _flat(batch.column(f"{side}_ends"))
            stops, rows = _flat(batch.column(f"{side}_stops"))
            self.ids.append(ids.astype(np.int64))
            self.offsets.append(offsets)
            self.ends.append(ends.astype(np.int64))
            self.stops.append(stops + np.repeat(offsets[:-1], np.diff(rows)))
        self.groups = np.diff(rows)
        offsets = self.offsets[0]
        sizes = np.where(np.diff(offsets) > 0, np.append(self.ends[0], 0)[offsets[1:] - 1], 0)
        # Each row's bytes follow those of the row before, on both sides.
        self.ends = [
            ends + np.repeat(np.cumsum(sizes) - sizes, np.diff(offsets))
            for ends, offsets in zip(self.ends, self.offsets)
        ]

    def digests(self) -> list[str]:
        """SHA-256 of each row's groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        (a, b), (a_stops, b_stops) = self.ids, self.stops
        a_group = np.repeat(np.arange(len(a_stops)), np.diff(a_stops, prepend=0))
        b_group = np.repeat(np.arange(len(b_stops)), np.diff(b_stops, prepend=0))
        signed = np.empty(len(a) + len(b), object)
        a_at = np.arange(len(a)) + np.concatenate([[0], b_stops])[a_group]
        b_at = np.arange(len(b)) + a_stops[b_group]
        signed[a_at], signed[b_at] = _named(a, b","), _named(b, b",")
        signed[a_at[a_stops - 1]] = _named(a[a_stops - 1], b"|")
        signed[b_at[b_stops - 1]] = _named(b[b_stops - 1], b";")
        offsets = (self.offsets[0] + self.offsets[1]).tolist()
        rows = [b"".join(signed[i:j].tolist())[:-1] for i, j in zip(offsets, offsets[1:])]
        return [hashlib.sha256(r).hexdigest() if r else "" for r in rows]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The pair of ids of each link, and the number of links of each row."""
        a_at, b_at = overlaps(*self.ends)
        row = np.repeat(np.arange(len(self.groups)), np.diff(self.offsets[0]))
        return self.ids[0][a_at] << B_BITS | self.ids[1][b_at], np.bincount(row[a_at], minlength=len(self.groups))


CHUNKS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places array<int>, pairs array<long>, counts array<long>"
)
CHUNK_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("places", pa.list_(pa.int32()))]
    + [(name, pa.list_(pa.int64())) for name in ("pairs", "counts")]
)


def chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of ``aligned`` as counts and digests, each with the number of its chunk
    and its links' places among the chunk's distinct pairs. Those and their counts
    are in the chunk's first row, the others have none.

    Tokens become links in the same task, so they never leave it. A row holds one
    text: readers and joins keep many rows, which must not be whole chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        rows: list[list] = [[] for _ in range(6)]
        pairs: list[np.ndarray] = []
        held = 0

        def chunk() -> pa.RecordBatch:
            flat = np.concatenate(pairs)
            pairs.clear()
            place, distinct = pd.factorize(flat)
            del flat
            counts = np.bincount(place, minlength=len(distinct))
            # Frequent pairs get small numbers, which take less room on disk.
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            n = len(rows[0])
            of_rows = pa.array(np.concatenate([[0], np.cumsum(rows[4])]), pa.int32())
            of_first = pa.array(np.repeat([0, len(order)], [1, n]), pa.int32())
            columns = [pa.array(v, f.type) for v, f in zip(([number] * n, *rows), CHUNK_SCHEMA)]
            columns.append(pa.ListArray.from_arrays(of_rows, pa.array(rank[place], pa.int32())))
            columns += [pa.ListArray.from_arrays(of_first, pa.array(v[order], pa.int64())) for v in (distinct, counts)]
            return pa.RecordBatch.from_arrays(columns, schema=CHUNK_SCHEMA)

        for part in _aligned(batches, a_path, b_path, TEXT_BYTES):
            found = _Rows(part)
            linked, n_links = found.links()
            rows[0] += part.column("doc_id").to_pylist()
            sizes = [np.diff(o) for o in found.offsets]
            for kept, new in zip(rows[1:], (*sizes, found.groups, n_links)):
                kept += new.tolist()
            rows[5] += found.digests()
            pairs.append(linked)
            held += int(sum(s.sum() for s in sizes))
            if held >= CHUNK_TOKENS:
                yield chunk()
                number += 1
                rows, pairs, held = [[] for _ in range(6)], [], 0
        if rows[0]:
            yield chunk()

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return texts.mapInArrow(run, CHUNKS)


def pair_counts(chunked: DataFrame) -> DataFrame:
    """pair (an A id and a B id), n (links that hold it in the corpus), and best:
    whether no pair of its B id has more."""
    each = chunked.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counted = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << B_BITS) - 1))
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_b))


def linked(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Links of each text's tokens, weighed by the whole corpus: doc_id, n_a, n_b,
    n_groups, n_links, n_best (links whose pair is the most frequent of its B id,
    ties included), count_sum (the counts of its links' pairs), and
    groups_sha256, the digest of its groups. Texts are taken as by ``aligned``;
    those without tokens have zeros.
    """
    chunked = saved(chunks(docs, a_path, b_path), "chunks", GROUP_BYTES)
    wanted = chunked.select(F.col("chunk").alias("of_chunk"), F.posexplode("pairs").alias("place", "pair"))
    priced = wanted.join(pair_counts(chunked).hint("shuffle_hash"), "pair").select("of_chunk", "place", "n", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(rows: pa.Table, prices: pa.Table) -> pa.Table:
        at = prices["place"].to_numpy()
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[at], best[at] = prices["n"].to_numpy(), prices["best"].to_numpy()
        place = np.concatenate([np.zeros(0, np.int32), *(c.flatten().to_numpy() for c in rows["places"].chunks)])
        ends = np.cumsum(rows["n_links"].to_numpy())
        sums = {name: np.concatenate([[0], np.cumsum(v[place])])[ends] for name, v in (("n_best", best), ("count_sum", n))}
        for name, v in sums.items():
            rows = rows.append_column(name, pa.array(np.diff(v, prepend=0), pa.int64()))
        return rows.select(names)

    both = chunked.drop("pairs", "counts").groupBy("chunk").cogroup(priced.groupBy("of_chunk"))
    return both.applyInArrow(run, ", ".join(f"{n} long" for n in names[:-1]) + ", groups_sha256 string")
