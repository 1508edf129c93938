"""Language by rank order: a text's most frequent n-grams against those of each language.

N-grams are runs of one to three letters of a word, with a blank before and
after it. A profile is the most frequent n-grams of a language in order; a text
is compared by how far each of its own most frequent n-grams is out of place,
and by the longest way for one that the profile lacks.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_parts

#: N-grams in a profile, of a language and of a text.
PROFILE = 300
#: More languages than this are an error: profiles pass the driver.
MAX_LANGUAGES = 2000
#: Languages' counts that a task holds before it passes them on.
HELD_GRAMS = 1 << 21
#: Characters of a text that are counted together; cut at white space.
WINDOW = 1 << 20
UNKNOWN = "und"

_SPACE = re.compile(r"\s")
_BLANK = 1


@lru_cache(1)
def _kinds() -> np.ndarray:
    """2 for letters, 1 for marks on letters, 0 for all other code points."""
    kinds = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        sign = unicodedata.category(chr(c))[0]
        if sign in "LM":
            kinds[c] = 2 if sign == "L" else 1
    return kinds


def _windows(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + WINDOW) if len(text) - start > WINDOW else None
        stop = cut.end() if cut else len(text)
        yield text[start:stop]
        start = stop


def grams(text: str) -> np.ndarray:
    """All n-grams of a text as numbers, 21 bits a character, repeats kept; none
    without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kinds = _kinds()[points]
    if not (kinds == 2).any():
        return np.zeros(0, np.int64)
    inside = np.concatenate([[False], kinds > 0, [False]])
    spaced = np.full(len(inside), _BLANK, np.int64)
    spaced[1:-1][inside[1:-1]] = points[inside[1:-1]]
    # One blank between words: of a gap, only what follows a word is kept.
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    c = np.concatenate([[_BLANK], spaced[keep]])
    one = c[c != _BLANK]
    two = c[:-1] << 21 | c[1:]
    three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[c[1:-1] != _BLANK]
    return np.concatenate([one, two, three])


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) == 1:
        return keys[0], counts[0]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text in order, and how often each occurs."""
    found = [np.unique(grams(w), return_counts=True) for w in _windows(text)] or [np.unique(grams(""), return_counts=True)]
    return _merged([f[0] for f in found], [f[1] for f in found])


def rank_order(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; equal ones by number."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class Profiles:
    """Languages in order of name, and the ranks of their n-grams."""

    ranks: dict[str, list[int]]
    size: int = PROFILE
    languages: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.languages = sorted(self.ranks)
        self.keys = np.unique(np.concatenate([np.array(v, np.int64) for v in self.ranks.values()] or [np.zeros(0, np.int64)]))
        self.places = np.full((len(self.keys) + 1, len(self.languages)), -1, np.int32)
        for n, language in enumerate(self.languages):
            profile = np.array(self.ranks[language], np.int64)
            self.places[np.searchsorted(self.keys, profile), n] = np.arange(len(profile))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language of least out-of-place distance, the first by name of equal
        ones, and 1 minus the distance's share of the greatest possible one."""
        own = rank_order(*gram_counts(text or ""), self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = 0
        places = self.places[np.where(self.keys[at] == own, at, len(self.keys))]
        apart = np.abs(places - np.arange(len(own), dtype=np.int32)[:, None])
        total = np.where(places < 0, self.size, apart).sum(0)
        best = int(total.argmin())
        return self.languages[best], 1 - float(total[best]) / (self.size * len(own))


def fit(docs: DataFrame, learned: Column, size: int = PROFILE) -> Profiles:
    """Profiles from all rows of ``docs`` where ``learned``, with a text and a ``lang``.

    Each task counts the n-grams of what it reads, so a shuffle moves one row per
    distinct n-gram and language of a task, however unequal the languages are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}
        waiting = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for language, found in held.items():
                keys, counts = _merged(*found)
                columns = [pa.array([language] * len(keys), pa.string()), pa.array(keys), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

        for batch in batches:
            for part in text_parts(batch, "text"):
                texts: dict[str, list[str]] = {}
                for language, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    texts.setdefault(language, []).append(text)
                for language, several in texts.items():
                    keys, counts = gram_counts("\n".join(several))
                    found = held.setdefault(language, ([], []))
                    found[0].append(keys)
                    found[1].append(counts)
                    waiting += len(keys)
            if waiting > HELD_GRAMS:
                held = {language: tuple([m] for m in _merged(*found)) for language, found in held.items()}
                waiting = sum(len(found[0][0]) for found in held.values())
                if waiting > HELD_GRAMS // 2:
                    yield from counted()
                    held, waiting = {}, 0
        yield from counted()

    texts = docs.where(learned & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counted = texts.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    top = counted.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= size)
    rows = top.select("lang", "rank", "gram").limit(MAX_LANGUAGES * size + 1).collect()
    if len(rows) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    ranks: dict[str, list[int]] = {}
    for language, _, gram in sorted(rows):
        ranks.setdefault(language, []).append(gram)
    return Profiles(ranks, size)


def held_out() -> Column:
    """True for rows that no language may be learned from; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predicted(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1, higher: closer to the profile) of each row.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text where no language was learned. Languages without any letter in their
    texts are not learned. Null or repeated doc_ids stay, each row for itself;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, "text"):
                found = [profiles.nearest(text) for text in part.column("text").to_pylist()]
                columns = [
                    part.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
