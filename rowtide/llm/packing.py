"""Cost-balanced packing of documents into token sequences.

Each task packs blocks of the documents it reads, so nothing is shuffled. In a
block, whole sequences are cut off long documents; the rest go, longest first,
to the sequence of lowest estimated cost that has room. The cost of a piece is
linear in its length plus quadratic for attention. A block's sequences hold
exactly its tokens: all have ``seq_len`` tokens but the last few, whose lengths
are powers of two that need no padding.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_characters
from .common import kept_by_worker, whole_text

#: Tokens per sequence.
SEQ_LEN = 2048
#: Tokens that a task packs together, at least; bounds its memory.
BLOCK_TOKENS = 1 << 20
#: Cost of a token, and of a pair of tokens in one piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Id that ends each document.
END_ID = 1
#: Words and pieces that a worker remembers, about 200 bytes each; beyond it, memory is cleared, results stay the same.
REMEMBERED = 400_000
#: A text that tells tokenizers with other rules for words apart.
PROBE = "Don't  stop,it's 12,345 Naïve\n\tÜnïcode-words!? a_b ''ll #x 日本 é"
#: Words of these characters are split here; the tokenizer splits all others.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
#: The file's split pattern for lower-cased plain words.
PLAIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Words:
    """Encodes words in one worker; remembers words, and their pieces, with ids.

    The tokenizer drops white space and its tokens never cross it, so a text's
    ids are those of its parts between ASCII white spaces.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.shown = byte_characters()
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        ids = [int.from_bytes(raw[i : i + 4], "little") for raw in [self.encode(PROBE.encode())] for i in range(0, len(raw), 4)]
        if ids != self.tokenizer.encode(PROBE, add_special_tokens=False).ids:
            raise ValueError(f"{path} does not encode texts word by word as this operator does")

    def piece(self, piece: str) -> bytes:
        """Ids of one match of the tokenizer's split pattern."""
        ids = self.pieces.get(piece)
        if ids is None:
            shown = "".join([self.shown[b] for b in piece.encode()])
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
            if len(piece) <= 64:
                self.pieces[piece] = ids
        return ids

    def word(self, raw: bytes) -> bytes:
        word = raw.decode("utf-8", "replace")
        if PLAIN.fullmatch(word) and "<|" not in word:
            ids = b"".join(map(self.piece, PLAIN_PIECES.findall(word.lower())))
        else:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
            ids = b"".join([i.to_bytes(4, "little") for i in found])
        if len(raw) <= 64:
            self.words[raw] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if len(self.words) + len(self.pieces) > REMEMBERED:
            self.words.clear()
            self.pieces.clear()
        get, word = self.words.get, self.word
        return b"".join([get(w) or word(w) for w in text.split()])


def known_words(path: str) -> Words:
    """The worker's encoder."""
    return kept_by_worker(("packing", path), lambda: Words(path))


def capacities(tokens: int, seq_len: int) -> list[int]:
    """Lengths of the sequences that hold so many tokens without padding."""
    rest = tokens % seq_len
    tail = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return [seq_len] * (tokens // seq_len) + tail


def assign(lengths: list[int], seq_len: int = SEQ_LEN) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece.

    Every token of every document lies in exactly one piece.
    """
    pieces, rest, sequence = [], [], 0
    for d, n in enumerate(lengths):
        whole = n - n % seq_len
        for start in range(0, whole, seq_len):
            pieces.append((d, start, seq_len, sequence, 0))
            sequence += 1
        if n > whole:
            rest.append((n - whole, d, whole))
    room = capacities(sum(r[0] for r in rest), seq_len)
    filled = [0] * len(room)
    heap = [(0.0, s) for s in range(len(room))]
    rest.sort(key=lambda r: (-r[0], r[1]))
    for n, d, start in rest:
        while n:
            cost, s = heapq.heappop(heap)
            took = min(n, room[s] - filled[s])
            pieces.append((d, start, took, sequence + s, filled[s]))
            filled[s] += took
            start, n = start + took, n - took
            if filled[s] < room[s]:
                heapq.heappush(heap, (cost + LINEAR * took + QUADRATIC * took * took, s))
    return pieces


def pack(
    docs: DataFrame, path: str, seq_len: int = SEQ_LEN, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian
    unsigned 32-bit numbers), doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone. doc_id may be null or repeat; each
    row is a document of its own. Other columns are ignored. A text of any
    length is taken whole; the tokens of one text must fit in a task.
    """
    if seq_len < 1 or seq_len & (seq_len - 1):
        raise ValueError("seq_len must be a power of two")
    end = END_ID.to_bytes(4, "little")

    def packed(block: list[tuple[int | None, bytes]], first: int) -> tuple[pa.RecordBatch, int]:
        rows = assign([len(ids) // 4 for _, ids in block], seq_len)
        columns = [
            pa.array([block[d][0] for d, *_ in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int64()),
            pa.array([block[d][1][4 * s : 4 * (s + n)] for d, s, n, *_ in rows], pa.binary()),
            pa.array([len(block[d][1]) // 4 for d, *_ in rows], pa.int64()),
            pa.array([first + r[3] for r in rows], pa.int64()),
            pa.array([r[4] for r in rows], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names), first + max(r[3] for r in rows) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_words(path)
        first = TaskContext.get().partitionId() << 33
        block: list[tuple[int | None, bytes]] = []
        tokens = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512).to_pydict()
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    ids = known.encode(text)
                    block.append((doc_id, ids + end))
                    tokens += len(ids) // 4 + 1
                    if tokens >= block_tokens:
                        out, first = packed(block, first)
                        yield out
                        block, tokens = [], 0
        if block:
            yield packed(block, first)[0]

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    texts = docs.select(F.col("doc_id").cast("long"), whole_text().cast("binary").alias("text"))
    return texts.mapInArrow(run, schema)
