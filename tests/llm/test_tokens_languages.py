"""Alignment, importance resampling and language against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowtide.llm import alignment, importance, languages, queries

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
#: Nulls, empty, repeated rows, a null id, characters of several bytes, text that a side changes.
EDGES = [
    (1, None),
    (2, ""),
    (3, "a  b\n\n é😀 日本語 <|endoftext|> </s> <0x41>"),
    (3, "a  b\n\n é😀 日本語 <|endoftext|> </s> <0x41>"),
    (None, "x y"),
    (5, " \n "),
    (6, "one ▁ block sign"),
    (7, "nul \0 inside"),
    (8, "Überraschung, naïve don't 12345"),
]


def table(spark, rows, schema="doc_id long, text string"):
    clash = {"chunk": F.lit(7), "rank": F.lit("r"), "row": F.lit(1), "score": F.lit(0), "pairs": F.lit("p")}
    return spark.createDataFrame(rows, schema).withColumns(clash)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    shown = [c for c in range(33, 127)] + [c for c in range(161, 256) if c != 173]
    code = {chr(c): c for c in shown}
    code |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def tokens(text):
        """[(id, first byte, byte after the last)] on both sides; none unless both spell space and text."""
        found = []
        for ids, spelt in (
            ((x := a.encode(" " + text, add_special_tokens=False)).ids, [bytes(code[c] for c in t) for t in x.tokens]),
            (
                y := b.encode(text),
                [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]],
            ),
        ):
            if not text or b"".join(spelt) != (" " + text).encode():
                return [], []
            at, side = 0, []
            for i, raw in zip(ids, spelt):
                side.append((i, at, at + len(raw)))
                at += len(raw)
            found.append(side)
        return found

    return tokens


def aligned_by_brute_force(rows, tokens):
    out, counts = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(text or "")
        both = sorted({t[2] for t in a} & {t[2] for t in b})
        groups, start = [], 0
        for end in both:
            inside = [[t[0] for t in side if start <= t[1] and t[2] <= end] for side in (a, b)]
            groups.append("|".join(",".join(map(str, ids)) for ids in inside))
            start = end
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        counts.update(links)
        out.append((doc_id, len(a), len(b), groups, links))
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(n, highest.get(y, 0))
    return [
        (
            doc_id,
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(counts[x] == highest[x[1]] for x in links),
            sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, n_a, n_b, groups, links in out
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows, columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)


def test_alignment_equals_brute_force(spark, sides, monkeypatch):
    rows = EDGES + [(10 + i, prose(i, 5 + 7 * i)) for i in range(12)] + [(40 + i, prose(1, 12)) for i in range(20)]
    got = alignment.linked(table(spark, rows).repartition(3), A, B)
    assert got.columns == COLUMNS
    want = sorted(aligned_by_brute_force(rows, sides), key=repr)
    assert plain(got.collect(), COLUMNS) == want
    assert sum(w[1] for w in want) > 500 and any(w[3] < w[1] for w in want)


def test_alignment_over_many_chunks(spark, sides, monkeypatch):
    # A chunk for each few texts that are encoded together.
    monkeypatch.setattr(alignment, "TEXT_BYTES", 500)
    monkeypatch.setattr(alignment, "CHUNK_TOKENS", 1)
    rows = [(i, prose(i % 9, 3 + i % 9)) for i in range(600)]
    docs = table(spark, rows).coalesce(1)
    assert alignment.chunks(docs, A, B).count() > 1
    assert plain(alignment.linked(docs, A, B).collect(), COLUMNS) == sorted(aligned_by_brute_force(rows, sides), key=repr)


def test_alignment_keeps_one_text_in_a_row(spark, sides):
    # A row of a whole chunk would be held many times over by readers and joins.
    rows = [(i, prose(i % 9, 3 + i % 9)) for i in range(600)] + [(None, ""), (None, None)]
    found = alignment.chunks(table(spark, rows).coalesce(1), A, B).collect()
    assert len(found) == len(rows) and {r.chunk for r in found} == {found[0].chunk}
    assert all(len(r.places) == r.n_links for r in found)
    assert [len(r.pairs) > 0 for r in found] == [True] + [False] * (len(rows) - 1)
    assert {p for r in found for p in r.places} == set(range(len(found[0].pairs)))
    plan = alignment.linked(table(spark, rows), A, B)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan


def test_alignment_of_chunks_without_pairs(spark, sides):
    rows = [(1, ""), (None, None), (3, "▁")]
    got = plain(alignment.linked(table(spark, rows).repartition(3), A, B).collect(), COLUMNS)
    assert got == sorted(aligned_by_brute_force(rows, sides), key=repr)


def test_alignment_rows_keep_tokens_and_groups(spark, sides):
    rows = {r.doc_id: r for r in alignment.aligned(table(spark, [(1, "naïve 日本"), (2, None), (3, "▁")]), A, B).collect()}
    a, b = sides("naïve 日本")
    assert rows[1].a_ids == [t[0] for t in a] and rows[1].a_ends == [t[2] for t in a]
    assert rows[1].b_ids == [t[0] for t in b] and rows[1].b_ends == [t[2] for t in b]
    assert rows[1].a_stops[-1] == len(a) and rows[1].b_stops[-1] == len(b)
    assert [rows[1].a_ends[s - 1] for s in rows[1].a_stops] == [rows[1].b_ends[s - 1] for s in rows[1].b_stops]
    assert rows[2].a_ids == rows[3].a_ids == rows[3].b_stops == []


def test_words_are_encoded_as_in_their_texts(sides, monkeypatch):
    both = alignment.Sides(A, B)
    assert both.apart
    rng = random.Random(8)
    parts = ["a", "Ab", "don't", "'s", "12", "é", "日本", "😀", "\n", "\n\n", " ", "  ", ".", ",\u00a0", "\t", "▁", "\0", "w" * 90]
    texts = ["".join(rng.choice(parts + [" "] * 9) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += [" ".join(rng.choice(parts).strip() or "x" for _ in range(9)) for _ in range(1000)]
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    got = [f for at in range(0, len(texts), 37) for f in both.tokens(texts[at : at + 37])]
    for text, (a, b) in zip(texts, got):
        assert [a.tolist(), b.tolist()] == [[t[0] for t in side] for side in sides(text)], text
    assert not any(len(w) > 64 for w in both.known)


def test_alignment_of_a_long_text_and_of_no_rows(spark):
    long = prose(5, 60_000)
    row = alignment.linked(table(spark, [(1, long), (2, "short")]), A, B).where("doc_id = 1").first()
    assert row.n_links >= max(row.n_a, row.n_b) and row.n_links == row.n_a + row.n_b - row.n_groups
    assert alignment.linked(table(spark, []), A, B).collect() == []


def test_crc_matrices_equal_zlib():
    raw = np.frombuffer(random.Random(3).randbytes(4000), np.uint8)
    starts = np.array([0, 5, 5, 100, 3000, 7, 0, 11])
    lengths = np.array([1, 3, 3, 256, 300, 1, 4000, 0])
    assert importance.crc_slices(raw, starts, lengths).tolist() == [
        zlib.crc32(raw[s : s + n].tobytes()) for s, n in zip(starts, lengths)
    ]


def resampled_by_brute_force(rows, target, percent=5, least=20):
    def features(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    found = [(doc_id, *features(text)) for doc_id, text in rows]
    s, t = Counter(), Counter()
    for _, _, f in found:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    S, T = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)}
    scored = []
    for doc_id, words, f in found:
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        scored.append((doc_id, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0], r[2]))
    drawn = able[: len(able) * percent // 100]
    rest = [(*r, None) for r in scored]
    for n, r in enumerate(drawn):
        rest[rest.index((*r, None))] = (*r, n + 1)
    return sorted(rest, key=repr)


SCORED = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


@pytest.mark.parametrize("chunk", [1, 2, 5, 1000])
def test_features_do_not_depend_on_chunks(monkeypatch, chunk):
    monkeypatch.setattr(importance, "CHUNK_WORDS", chunk)
    texts = [b"", b"Ab ab, cd ab ab cd", b"-", "é é x1 é é x1".encode(), b"y", b"a " * 30]
    got = [(int(t), int(b)) for found in importance.Words(texts).buckets(10000) for t, b in zip(*found)]
    want = []
    for t, text in enumerate(texts):
        w = re.findall(rb"[0-9a-z\x80-\xff]+", text.lower())
        want += [(t, zlib.crc32(b" ".join(w[i : i + n])) % 10000) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("range_rows", [500_000, 7])
def test_resampling_equals_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr(importance, "RANGE_ROWS", range_rows)
    rows = EDGES + [(100 + i, prose(i % 90, 10 + i % 40)) for i in range(400)]
    rows += [(100, prose(0, 10)), (9, "w" * 5000 + " tail " + "v" * 300), (None, prose(77, 30))]
    target = [prose(i, 30) for i in range(5)] + [None, ""]
    goal = table(spark, list(enumerate(target)))
    got = importance.resample(table(spark, rows), goal, percent=20)
    assert got.columns == SCORED
    assert plain(got.collect(), SCORED) == resampled_by_brute_force(rows, target, 20)


def test_resampling_of_few_or_no_rows(spark):
    goal = table(spark, [(0, None)])
    rows = [(1, prose(1, 30)), (2, None), (3, "few words")]
    assert plain(importance.resample(table(spark, rows), goal).collect(), SCORED) == resampled_by_brute_force(rows, [None])
    assert importance.resample(table(spark, []), goal).collect() == []
    long = [(1, prose(4, 200_000)), (2, prose(4, 21))] * 20
    got = importance.resample(table(spark, long), goal, percent=50)
    assert plain(got.collect(), SCORED) == resampled_by_brute_force(long, [None], 50)


def grams_by_brute_force(text):
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c
        elif word:
            words, word = [*words, word], ""
    found = Counter()
    if any(c.isalpha() for c in (text or "")):
        for w in words:
            found.update(w)
            found.update(f"\1{w}\1"[i : i + 2] for i in range(len(w) + 1))
            found.update(f"\1{w}\1"[i : i + 3] for i in range(len(w)))
    number = {g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in found}
    return sorted(found, key=lambda g: (-found[g], number[g])), found, number


def predicted_by_brute_force(rows, learned, size):
    total = {}
    for text, lang in learned:
        total.setdefault(lang, Counter()).update(grams_by_brute_force(text)[1])
    number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    order = {lang: sorted(n, key=lambda g: (-n[g], number(g)))[:size] for lang, n in total.items() if n}
    out = []
    for doc_id, text in rows:
        own = grams_by_brute_force(text)[0][:size]
        away = {
            lang: sum(abs(p.index(g) - r) if g in p else size for r, g in enumerate(own)) for lang, p in order.items()
        }
        if own:
            best = min(away, key=lambda lang: (away[lang], lang))
            out.append((doc_id, best, 1 - away[best] / (size * len(own))))
        else:
            out.append((doc_id, "und", 0.0))
    return sorted(out, key=repr)


def test_grams_do_not_depend_on_windows(monkeypatch):
    text = "One twö नमस्ते, ΣΑΣ! " * 9 + "x" * 70 + " end"
    whole = languages.gram_counts(text)
    monkeypatch.setattr(languages, "WINDOW", 20)
    assert len(list(languages._windows(text))) > 5
    assert all((a == b).all() for a, b in zip(whole, languages.gram_counts(text)))
    assert dict(zip(*map(np.ndarray.tolist, whole))) == {
        n: grams_by_brute_force(text)[1][g] for g, n in grams_by_brute_force(text)[2].items()
    }


@pytest.mark.parametrize("held", [1 << 21, 40])
def test_language_equals_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(languages, "HELD_GRAMS", held)
    said = {"en": "the cat and the dog were here", "de": "der Hund und die Straße, ÜBER uns", "xx": "日本語 नमस्ते", "no": "12 !"}
    rng = random.Random(5)
    learned = []
    for lang, line in said.items():
        learned += [(i, " ".join(rng.choices(line.split(), k=12)), lang) for i in range(30)]
    learned += [(1, None, "en"), (2, "no language", None), (3, "", "fr")]
    schema = "doc_id long, text string, lang string"
    profiles = languages.fit(table(spark, learned, schema), F.lit(True), size=20)
    rows = EDGES + [(20 + i, r[1]) for i, r in enumerate(learned)]
    got = languages.predicted(table(spark, rows), profiles)
    pairs = [(r[1], r[2]) for r in learned if r[1] is not None and r[2] is not None]
    assert plain(got.collect(), ["doc_id", "lang_pred", "score"]) == predicted_by_brute_force(rows, pairs, 20)


def test_language_without_rows_or_languages(spark):
    schema = "doc_id long, text string, lang string"
    none = languages.fit(table(spark, [(1, "text", None)], schema), F.lit(True))
    assert languages.predicted(table(spark, [(1, "text")]), none).first()[1:] == ("und", 0.0)
    assert languages.predicted(table(spark, []), none).collect() == []
    monkey = [(i, "ab", f"l{i}") for i in range(5)]
    languages.MAX_LANGUAGES, kept = 3, languages.MAX_LANGUAGES
    try:
        with pytest.raises(ValueError, match="languages"):
            languages.fit(table(spark, monkey, schema), F.lit(True), size=2)
    finally:
        languages.MAX_LANGUAGES = kept


def test_language_held_out_accuracy(spark, sf_dir):
    got = queries.op13_language(spark, sf_dir).join(queries.documents(spark, sf_dir).select("doc_id", "lang"), "doc_id")
    rows = [r for r in got.collect() if r.held_out and r.lang_pred != "und" and r.lang]
    assert len(rows) > 40
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
