"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file becomes a vocabulary over the byte-to-character alphabet. Texts go
through Python in Arrow batches. They are cut at white space, where encodings
fall apart, so that each worker encodes a part once and remembers it.

``PLAIN_PIECES`` is the pattern ``public_tokenizers.PATTERN`` over plain
characters; another pattern is followed only through the tokenizer.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_by_worker, whole_text

#: Parts and pieces that a worker remembers, about 200 bytes each; beyond it, memory is cleared, results stay the same.
REMEMBERED = 400_000
#: Bytes of text per output batch.
BATCH_BYTES = 8 << 20

#: The characters that Unicode calls white space.
SPACES = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
TWO_SPACES = re.compile(f"[{SPACES}][{SPACES}]")
RUN_BUT_LAST = re.compile(f"([{SPACES}]+)(?=[{SPACES}][^{SPACES}])")
#: Texts of these characters are split here; the tokenizer splits all others.
PLAIN = re.compile("[\n !-~À-ÖØ-öø-ÿ]*")
#: The split pattern for plain texts.
PLAIN_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\\s+(?!\\S)|\\s+"
)


@lru_cache(1)
def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def byte_table(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def load(path: str, pattern: str):
    """The tokenizer of a rank file, and the bytes of each id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = read_ranks(path)
    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    # Every split into two known tokens is a merge, ordered by the rank of the result.
    merges = []
    for token, rank in ranks.items():
        splits = [
            (ranks[token[:i]], ranks[token[i:]], name[token[:i]], name[token[i:]])
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        merges += [(rank, *s) for s in sorted(splits)]
    merges.sort()
    model = models.BPE(
        vocab={name[t]: r for t, r in ranks.items()},
        merges=[(m[3], m[4]) for m in merges],
        ignore_merges=True,
    )
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer, byte_table(ranks)


class Encoder:
    """Encodes texts in one worker; remembers parts of texts and their ids.

    A text is cut where its encoding falls apart: before the last of several
    white spaces, and at single spaces and line ends. Each part is encoded once
    while it is remembered.
    """

    def __init__(self, path: str, pattern: str):
        self.tokenizer, self.table = load(path, pattern)
        self.model = self.tokenizer.model
        self.apart = pattern == PATTERN
        self.shown = byte_characters()
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.parts: dict[str, tuple[int, ...]] = {}

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one match of the pattern."""
        ids = self.pieces.get(piece)
        if ids is None:
            shown = "".join([self.shown[b] for b in piece.encode()])
            ids = tuple([t.id for t in self.model.tokenize(shown)])
            if len(piece) <= 64:
                self.pieces[piece] = ids
        return ids

    def run(self, text: str) -> tuple[int, ...]:
        """Ids of a text that is cut nowhere."""
        if PLAIN.fullmatch(text):
            return tuple(chain.from_iterable(map(self.piece, PLAIN_PIECES.findall(text))))
        return tuple(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def part(self, part: str) -> tuple[int, ...]:
        """Ids of what follows a single space, or of a line end and what follows."""
        ids = self.run(part if part[:1] == "\n" else " " + part)
        if len(part) <= 64:
            self.parts[part] = ids
        return ids

    def spaced(self, text: str) -> list[int]:
        """Ids of a text without adjacent white spaces."""
        first, *rest = text.replace("\n", " \n").split(" ")
        get, part = self.parts.get, self.part
        ids = list(self.run(first)) if first else []
        for p in rest:
            found = get(p)
            ids += part(p) if found is None else found
        return ids

    def encode(self, text: str) -> list[int]:
        if not self.apart:  # where another pattern cuts is its own affair
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if len(self.pieces) + len(self.parts) > REMEMBERED:
            self.pieces.clear()
            self.parts.clear()
        if not TWO_SPACES.search(text):
            return self.spaced(text)
        body = text.rstrip(SPACES)
        end = text[len(body) :]
        if len(end) < 2:
            body, end = text, ""
        ids: list[int] = []
        for i, section in enumerate(RUN_BUT_LAST.split(body)):
            ids += self.run(section) if i % 2 else self.spaced(section)
        return ids + list(self.run(end))


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder."""
    return kept_by_worker(("byte_bpe", path, pattern), lambda: Encoder(path, pattern))


def char_spans(text: str, ids: list[int], table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end in characters of each id; ids that share a split character
    both cover it whole."""
    raw = np.frombuffer(text.encode(), np.uint8)
    leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    ends = np.cumsum([len(table[i]) for i in ids]).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    inside = np.zeros(len(raw) + 1, bool)
    inside[: len(raw)] = (raw & 0xC0) == 0x80
    return (leads[starts] - inside[starts]).astype(np.int32), leads[ends].astype(np.int32)


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about BATCH_BYTES of text each, one row at least."""
    sizes = [len(v) if v is not None else 0 for v in batch.column(column).to_pylist()]
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > BATCH_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def _lists(values: list, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = (
        np.concatenate(values).astype(np.int32)
        if values and isinstance(values[0], np.ndarray)
        else np.fromiter(chain.from_iterable(values), np.int32, int(offsets[-1]))
    )
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def decoded_rows(rows: list[list[int] | None], table: list[bytes]) -> pa.Array:
    """The bytes that each row's ids spell."""
    return pa.array([b"".join(map(table.__getitem__, row or ())) for row in rows], pa.binary())


def encode(
    docs: DataFrame, path: str, pattern: str, offsets: bool = False, decoded: bool = False
) -> DataFrame:
    """doc_id and ``ids`` (array of int) of each whole text, one row per row.

    With ``offsets``, also ``starts`` and ``ends``: the characters that each id
    covers. With ``decoded``, also what ``decode`` makes of the ids, in the same
    worker. A null text counts as empty and has no ids; doc_id may be null or
    repeat; other columns are ignored. Strings of special tokens are ordinary
    text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path, pattern)
        for batch in batches:
            for part in _slices(batch, "text"):
                texts = part.column("text").to_pylist()
                ids = [known.encode(t) for t in texts]
                out = [part.column("doc_id"), _lists(ids, pa.int32())]
                if offsets:
                    table = known.table
                    spans = [char_spans(t, i, table) for t, i in zip(texts, ids)]
                    out += [_lists([s[k] for s in spans], pa.int32()) for k in (0, 1)]
                if decoded:
                    out.append(decoded_rows(ids, known.table))
                yield pa.RecordBatch.from_arrays(out, names=names)

    names = ["doc_id", "ids"] + ["starts", "ends"] * offsets + ["decoded"] * decoded
    schema = "doc_id long, ids array<int>" + ", starts array<int>, ends array<int>" * offsets
    schema += ", decoded binary" * decoded
    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with ``decoded``, the bytes of the ids.

    Bytes stay bytes: ids that hold part of a character decode too, alone or
    together. Null ids count as none. An id that is not in the vocabulary is an
    error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_by_worker(("byte_bpe", "bytes", path), lambda: byte_table(read_ranks(path)))
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 256):
                part = batch.slice(at, 256)
                decoded = decoded_rows(part.column("ids").to_pylist(), table)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), decoded],
                    names=["doc_id", "ids", "decoded"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
