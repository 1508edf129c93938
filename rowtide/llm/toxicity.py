"""Toxicity by a string-kernel support vector machine with Nyström landmarks.

A word's kernel with a landmark counts their common subsequences of three
letters, weighted down for gaps, so that insults with inserted or missing
letters stay close to the plain ones. A sentence's features are the largest
kernels of its words with each landmark; a linear machine over the whitened
features scores it, and a document counts as its worst sentence does.

Landmarks are words that far more toxic documents than others hold, each time
after another word, and the most frequent clean words that resemble them. All fitting uses a
bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_by_worker, saved, text_parts, whole_text
from .near_dedup import signatures

#: Labelled rows that are used for fitting, at most: toxic and other.
TOXIC_ROWS, CLEAN_ROWS = 1000, 3000
#: Texts that share any of so many minwise tokens count as near copies in fitting.
COPY_TOKENS = 6
#: Landmarks at most: insults, and clean words like them.
INSULTS, LOOKALIKES = 48, 16
#: Words expected to pass as landmarks by chance, over the whole vocabulary.
CHANCE_WORDS = 0.05
#: Weight of a letter of a matched subsequence, gaps included, and its length.
DECAY, LENGTH = 0.6, 3
#: Letters of a word compared at once; longer words are cut into overlapping windows.
WIDTH = 24
#: Share of a landmark's letter pairs that a similar word must have, adjacent or
#: with one letter between; and the least kernel: all others count as 0.
LEAST_PAIRS, LEAST_KERNEL = 0.6, 0.3
#: Score from which a document is toxic.
THRESHOLD = 0.7
#: Words that a worker remembers: those without features, about 120 bytes each,
#: and those with some, about 400. Beyond it, memory is cleared, results stay the same.
REMEMBERED, REMEMBERED_HOT = 400_000, 50_000

#: Bytes of text that the filter scores at once: words, units and kernels of all are held.
FILTER_BYTES = 256 << 10

LETTERS = re.compile(r"[^\W\d_]+")
#: Signs at a word's ends that do not change what it is compared as.
SIGNS = ".,;:!?\"'()[]-"
#: Pairs of words whose kernels are computed at once.
BLOCK = 1024

_CODE = np.zeros(256, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[0xDF:0x100] = 27 + np.arange(0x100 - 0xDF) % 5
_CODE[ord("^")] = 32  # where a word begins
#: Letters above Latin-1 share the codes from 33 to 255: a prime number of
#: codes, so that the letters of an alphabet, which lie close, get different ones.
FIRST_WIDE, WIDE_CODES = 33, 223
#: Of a word that can be compared at least two letters have a code.
COMPARED = r"[a-zß-ÿ\x{100}-\x{10FFFF}].*[a-zß-ÿ\x{100}-\x{10FFFF}]"


def units(word: str) -> list[str]:
    """What a lower-cased word is compared as: its letters joined, and its parts
    between other characters; long ones as windows."""
    parts = LETTERS.findall(word)
    joined = "".join(parts)
    found = []
    for unit in dict.fromkeys([joined, *parts]):
        if len(unit) < WIDTH:
            found.append(unit)
        else:
            found += [unit[i : i + WIDTH - 1] for i in range(0, len(unit) - WIDTH // 2, WIDTH // 2)]
    return [u for u in found if len(u) >= LENGTH]


def coded(words: list[str]) -> np.ndarray:
    """Letters as small numbers after a sign for the start, one row per word;
    other characters are gaps."""
    raw = "".join(["^" + w.ljust(WIDTH - 1, "\0") for w in words])
    points = np.frombuffer(raw.encode("utf-32-le", "replace"), np.uint32)
    wide = (FIRST_WIDE + points % WIDE_CODES).astype(np.uint8)
    return np.where(points < 256, _CODE[points & 255], wide).reshape(-1, WIDTH)


_FAR = DECAY ** np.maximum(np.arange(WIDTH)[None] - np.arange(WIDTH)[:, None] + 2, 0)
_FAR = np.where(np.arange(WIDTH)[None] >= np.arange(WIDTH)[:, None], _FAR, 0)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of each row of ``s`` with that of ``t``."""
    total = np.empty(len(s))
    order = np.argsort(widths(s), kind="stable")
    for at in range(0, len(s), BLOCK):
        rows = order[at : at + BLOCK]
        total[rows] = _kernel(s[rows], t[rows])
    return total


def widths(codes: np.ndarray) -> np.ndarray:
    """Places of each row up to its last letter."""
    return WIDTH - (codes[:, ::-1] > 0).argmax(1)


def _kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    # Places after the last letter match nothing, so they are left out.
    m, n = widths(s).max(), widths(t).max()
    s, t, far = s[:, :m], t[:, :n], _FAR[:m, :m]
    match = [((s == t[:, j, None]) & (s > 0)).astype(float) for j in range(n)]
    prefix = [np.ones((len(s), m))] * n
    for step in range(LENGTH - 1):
        after = [np.zeros((len(s), m))]
        for j in range(n - 1):
            before = np.empty((len(s), m))
            before[:, 1:] = prefix[j][:, :-1]
            before[:, 0] = 1 if step == 0 else 0
            before *= match[j]
            after.append(DECAY * after[j] + before @ far)
        prefix = after
    total = np.zeros(len(s))
    for j in range(n):
        total += DECAY**2 * (match[j][:, 1:] * prefix[j][:, :-1]).sum(1)
    return total


@dataclass
class Landmarks:
    """Words with which others are compared."""

    words: list[str]
    codes: np.ndarray = field(init=False)
    own: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.codes = coded(self.words)
        self.own = kernel(self.codes, self.codes)
        self.pairs = _pairs(self.codes, 1)
        self.least = np.ceil(LEAST_PAIRS * np.bitwise_count(self.pairs).sum(1))

    def kernels(self, found: list[str]) -> np.ndarray:
        """Normalised kernels, a row per unit; 0 where too few letters are shared."""
        out = np.zeros((len(found), len(self.words)))
        if not found or not self.words:
            return out
        codes = coded(found)
        low, high = np.ascontiguousarray(_pairs(codes, 2).T)
        pairs = []
        for k in range(len(self.words)):
            shared = np.bitwise_count(self.pairs[k, 0] & low) + np.bitwise_count(self.pairs[k, 1] & high)
            pairs.append(np.flatnonzero(shared >= self.least[k]))
        rows = np.concatenate(pairs)
        if not len(rows):
            return out
        cols = np.repeat(np.arange(len(self.words)), [len(p) for p in pairs])
        used, at = np.unique(rows, return_inverse=True)
        own = kernel(codes[used], codes[used])
        out[rows, cols] = kernel(codes[rows], self.codes[cols]) / np.sqrt(own[at] * self.own[cols] + 1e-300)
        out[out < LEAST_KERNEL] = 0
        return out


def _pairs(codes: np.ndarray, reach: int) -> np.ndarray:
    """Letter pairs up to ``reach`` places apart, hashed into 128 bits per word."""
    bits = np.zeros((len(codes), 2), np.uint64)
    for gap in range(1, reach + 1):
        a, b = codes[:, :-gap].astype(np.uint64), codes[:, gap:].astype(np.uint64)
        place = ((a * np.uint64(33) + b) * np.uint64(2654435761) >> np.uint64(13)) & np.uint64(127)
        bit = np.where((a > 0) & (b > 0), np.uint64(1) << (place & np.uint64(63)), np.uint64(0))
        for half in range(2):
            bits[:, half] |= np.bitwise_or.reduce(np.where(place >> np.uint64(6) == half, bit, np.uint64(0)), axis=1)
    return bits


class Featurizer:
    """Features of the sentences of texts; remembers words without any."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.cold: set[str] = set()
        self.hot: dict[str, np.ndarray] = {}

    def learn(self, words: set[str]) -> set[str]:
        """Compare words that were not met before; those of ``words`` with features."""
        cold, hot = self.cold, self.hot
        whole, cut = {}, {}  # words compared as one unit, and as any number
        for w in words:
            if w in hot:
                continue
            plain = w.strip(SIGNS)
            if plain != w and plain in cold:
                cold.add(w)
            elif plain != w and plain in hot:
                hot[w] = hot[plain]
            elif LENGTH <= len(plain) < WIDTH and plain.isalpha():
                whole[w] = plain
            else:
                cut[w] = units(plain)
        flat = list(dict.fromkeys(chain(whole.values(), *cut.values())))
        values = self.landmarks.kernels(flat)
        row = {flat[i]: i for i in np.flatnonzero(values.any(1)).tolist()}
        warm = {w: values[row[u]].copy() for w, u in whole.items() if u in row}
        for w, us in cut.items():
            if not row.keys().isdisjoint(us):
                warm[w] = values[[row[u] for u in us if u in row]].max(0)
        hot.update(warm)
        cold.update(w for w in chain(whole, cut) if w not in warm and len(w) > 1)
        return {w for w in words if w in hot}

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the features of its sentences that have any. A sentence
        ends with a word that ends in a full stop, exclamation or question mark."""
        if len(self.cold) > REMEMBERED:
            self.cold.clear()
        if len(self.hot) > REMEMBERED_HOT:
            self.hot.clear()
        cold, hot = self.cold, self.hot
        split, words = [], set()
        for text in texts:
            split.append(text.lower().split())
            words.update(split[-1])
        words -= cold
        letters = {w for w in words if len(w) == 1}
        words = self.learn(words - letters) | letters
        warm, stops = [], []
        for ws in split:
            warm.append([(i, w) for i, w in enumerate(ws) if w in words])
            stops.append([i for i, w in enumerate(ws) if w[-1] in ".!?"] if len(warm[-1]) > 1 else [])
        apart = [self.spelled(found) for found in warm]
        self.learn({w for found in apart for _, w in found if w not in cold})
        out = []
        for found, joined, ends in zip(warm, apart, stops):
            found = [(i, hot[w]) for i, w in [*found, *joined] if w in hot]
            rows = np.array([row for _, row in found]) if found else np.zeros((0, len(self.landmarks.words)))
            if len(found) > 1:
                sentences: dict[int, int] = {}  # in the order in which they are met
                nr = np.array([sentences.setdefault(bisect_left(ends, i), len(sentences)) for i, _ in found])
                order = np.argsort(nr, kind="stable")
                rows = np.maximum.reduceat(rows[order], np.searchsorted(nr[order], np.arange(len(sentences))))
            out.append(rows)
        return out

    @staticmethod
    def spelled(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
        """Words whose letters are set apart, with the place of the first."""
        words, start, letters, last = [], 0, "", -9
        for i, w in [*found, (-9, "")]:
            if len(w) == 1 and i == last + 1:
                letters += w
            else:
                if len(letters) >= LENGTH:
                    words.append((start, letters))
                start, letters = i, w if len(w) == 1 else ""
            last = i
        return words


@dataclass
class Model:
    """A fitted machine; without landmarks all scores are ``base``."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    base: float

    def margins(self, features: list[np.ndarray]) -> np.ndarray:
        return np.array([max([0.0, *(f @ self.weights)]) + self.bias for f in features])

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        if not self.landmarks:
            return np.full(len(features), self.base)
        return 1 / (1 + np.exp(-(self.slope * self.margins(features) + self.offset)))


def _machine(x: np.ndarray, y: np.ndarray, cost: float = 5.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps; classes weigh alike."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w = np.zeros(x1.shape[1])
    ridge = np.eye(len(w)) / cost
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        active = y * (x1 @ w) < 1
        a = x1[active] * weight[active, None]
        new = np.linalg.solve(ridge + a.T @ x1[active], a.T @ y[active])
        if np.allclose(new, w, atol=1e-10):
            break
        w = new
    return w[:-1], float(w[-1])


def _calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, slightly damped."""
    x = np.stack([margin, np.ones(len(margin))], 1)
    p = np.zeros(2)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        grad = x.T @ (q - y) + 1e-2 * np.array([p[0], 0])
        hess = (x * (q * (1 - q))[:, None]).T @ x + np.diag([1e-2, 1e-6])
        move = np.linalg.solve(hess, grad)
        p = p - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return float(p[0]), float(p[1])


def _sample(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """text and toxic of the labelled rows used for fitting, without near copies:
    copies would make any of their words look telling."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    known = known.where(usable & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS)
    chosen = chosen.unionByName(known.where("toxic = 0").orderBy(*order).limit(CLEAN_ROWS))
    # At most TOXIC_ROWS + CLEAN_ROWS rows of two numbers.
    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    sample = saved(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "labelled")
    rows = sample.join(signatures(sample).select("doc_id", "tokens", "n_shingles"), "doc_id")
    rows = rows.where("n_shingles > 0")
    for i in range(COPY_TOKENS):
        # The smallest doc_id stays, so that every run fits the same model.
        alike = Window.partitionBy(F.get("tokens", F.lit(i))).orderBy("doc_id")
        rows = rows.withColumn("nr", F.row_number().over(alike)).where("nr = 1")
    return rows.select("text", "toxic")


def _in_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic"))):
            words = ["".join(LETTERS.findall(w)) for w in text.lower().split()]
            words = [w for w in words if w]
            first = {}  # one context for each word of a text
            for before, w in zip(["", *words], words):
                first.setdefault(w, before)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(first), pa.string()),
                    pa.array(list(first.values()), pa.string()),
                    pa.array([toxic] * len(first), pa.int32()),
                ],
                names=["unit", "before", "toxic"],
            )


def fit(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Fit on rows of ``labels`` (doc_id, toxic) for which ``usable``, a
    condition on doc_id, holds. Null labels or ids and other values than 0 and
    1 are ignored; of labels that repeat a doc_id the largest counts, of texts
    the smallest. Equal tables give equal models. Without rows of both classes the model has no landmarks."""
    sample = saved(_sample(docs, labels, usable), "sample")
    counts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    base = counts.get(1, 0) / max(1, sum(counts.values()))
    none = Model([], np.zeros(0), 0.0, 0.0, 0.0, base)
    if len(counts) < 2:
        return none
    seen = sample.mapInArrow(_in_context, "unit string, before string, toxic int").distinct()
    seen = seen.where(F.length("unit").between(LENGTH, WIDTH - 1)).groupBy("unit")
    seen = seen.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    seen = saved(seen, "words")  # copies repeat a context and count once
    # Twice the log-likelihood ratio exceeds x by chance with a probability of about exp(-x / 2).
    least_ratio = 2 * math.log(max(1, seen.count()) / CHANCE_WORDS)
    all_seen = F.col("bad") + F.col("good")
    ratio = 2 * F.col("bad") * F.log(F.col("bad") / (all_seen * base))
    ratio += F.when(F.col("good") > 0, 2 * F.col("good") * F.log(F.col("good") / (all_seen * (1 - base)))).otherwise(0)
    worst = (
        seen.where((F.col("bad") > 2 * all_seen * base) & F.col("unit").rlike(COMPARED))
        .withColumn("ratio", ratio)
        .where(F.col("ratio") >= least_ratio)
        .orderBy(F.desc("ratio"), "unit")
        .limit(INSULTS)
    )
    insults = [r.unit for r in worst.collect()]
    if not insults:
        return none
    like = Landmarks(insults)

    def resembling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("unit").to_pylist()
            near = like.kernels(words).max(1, initial=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("unit"), batch.column("good"), pa.array(near)], names=["unit", "good", "near"]
            )

    similar = (
        seen.where("bad = 0")
        .select("unit", F.col("good").cast("long"))
        .mapInArrow(resembling, "unit string, good long, near double")
        .where("near > 0")
        .orderBy(F.desc("good"), "unit")
        .limit(LOOKALIKES)
    )
    landmarks = Landmarks(insults + [r.unit for r in similar.collect()])
    bad = len(insults)

    def witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Featurizer(landmarks)
        for batch in batches:
            rows = features.texts(batch.column("text").to_pylist())
            worst = [r[r[:, :bad].max(1).argmax()] if len(r) else np.zeros(r.shape[1]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.tolist() for w in worst], pa.list_(pa.float64())), batch.column("toxic")],
                names=["features", "toxic"],
            )

    # One sentence, the most suspicious, of each sampled row.
    rows = sample.mapInArrow(witnesses, "features array<double>, toxic int").collect()
    x = np.array([r.features for r in rows])
    y = np.array([1.0 if r.toxic else -1.0 for r in rows])
    order = np.lexsort([*x.T, y])  # the same sums whatever the order of rows
    x, y = x[order], y[order]
    value, vector = np.linalg.eigh(_gram(landmarks))
    white = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    w, bias = _machine(x @ white, y)
    model = Model(landmarks.words, white @ w, bias, 0.0, 0.0, base)
    model.slope, model.offset = _calibrated(model.margins([r[None] for r in x]), (y > 0).astype(float))
    return model


def _gram(landmarks: Landmarks) -> np.ndarray:
    n = len(landmarks.words)
    i, j = np.indices((n, n)).reshape(2, -1)
    k = kernel(landmarks.codes[i], landmarks.codes[j]) / np.sqrt(landmarks.own[i] * landmarks.own[j])
    return k.reshape(n, n)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of each row's whole text; null counts as
    empty, and empty texts get the score of a text without any similar word.
    doc_id may be null or repeat; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (f"toxicity {model.landmarks}",)
        features = kept_by_worker(key, lambda: Featurizer(Landmarks(model.landmarks)))
        for batch in batches:
            for part in text_parts(batch, "text", 1 << 20):
                values = model.scores(features.texts(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"]
                )

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")


def held_out() -> Column:
    """True for rows that no label may be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, and predicted (1 if score >= 0.7, else 0)."""
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not judged toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Featurizer(Landmarks(model.landmarks))
        for batch in batches:
            for part in text_parts(batch, "text", FILTER_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield part.filter(pa.array(model.scores(features.texts(texts)) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
