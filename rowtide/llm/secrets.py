"""Secret scan with a battery of randomness tests, in DataFrame functions only.

Patterns give the base spans. Other long tokens are tested for being random in
the encoding their letters suggest: chi-squared uniformity over classes of the
alphabet, runs about the middle, and serial correlation. The least of the three
p-values, corrected for their number, decides against a limit per token length
that keeps the estimated share of ordinary tokens among the accepted below
``RATE``; the estimate takes the upper half of the p-values for random tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, whole_text

#: Fixed patterns; of an assignment, the value is group 1.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The same maximal runs as without a least length: shorter ones are dropped.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
#: Tokens that are tested.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
#: Order of kinds at equal starts.
KINDS = ("assign", "access", "hex", "random")
#: Share of ordinary tokens allowed among the accepted.
RATE = 0.1
#: Steps of the p-value.
STEPS = 100
#: What replaces a secret.
MASK = "[SECRET]"

_ALPHABET = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Letters that make up most of many languages' texts.
_COMMON = "aeinorstl"


def _spans(text: Column, pattern: str, kind: int, least: int | None = None) -> Column:
    """(start, kind, end) of each match, in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(done: Column, pair: Column) -> Column:
        begin = done["at"] + F.length(pair["between"])
        end = begin + F.length(pair["hit"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        more = F.array(span)
        if least is not None:
            value = F.regexp_extract(pair["hit"], pattern, 1)
            more = F.when(F.length(value) >= least, more).otherwise(none)
        return F.struct(end.alias("at"), F.concat(done["spans"], more).alias("spans"))

    pairs = F.arrays_zip(between.alias("between"), hits.alias("hit"))
    pairs = F.slice(pairs, F.lit(1), F.size(hits))
    found = F.aggregate(pairs, start, step, lambda done: done["spans"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, to about 1e-4."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _p_value(token: Column) -> Column:
    """Corrected p-value of a token's randomness; null for plain numbers."""
    size = F.length(token).cast("double")
    lower = F.lower(token)

    def tests(alphabet: str, symbols: Column, classes: list[tuple[str, float]]) -> Column:
        places = F.transform(F.split(symbols, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))
        middle = (len(alphabet) + 1) / 2
        chi = None
        for letters, share in classes:
            seen = size - F.length(F.translate(symbols, letters, ""))
            part = (seen - size * share) * (seen - size * share) / (size * share)
            chi = part if chi is None else chi + part
        df = len(classes) - 1
        far = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
        start = F.struct(
            F.lit(0.0).alias("last"),
            F.lit(0.0).alias("high"),
            F.lit(0.0).alias("runs"),
            F.lit(0.0).alias("squares"),
            F.lit(0.0).alias("products"),
        )

        def step(a: Column, x: Column) -> Column:
            d = x - middle
            return F.struct(
                d.alias("last"),
                (a["high"] + (d > 0).cast("double")).alias("high"),
                (a["runs"] + ((a["last"] == 0) | ((a["last"] > 0) != (d > 0))).cast("double")).alias("runs"),
                (a["squares"] + d * d).alias("squares"),
                (a["products"] + a["last"] * d).alias("products"),
            )

        def finish(a: Column) -> Column:
            high, low = a["high"], size - a["high"]
            mean = 2 * high * low / size + 1
            spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (size - 1), F.lit(1e-9)))
            runs = 2 * _tail(F.abs(a["runs"] - mean) / spread)
            serial = 2 * _tail(F.abs(a["products"] / a["squares"]) * F.sqrt(size))
            return F.least(F.lit(1.0), 3 * F.least(_tail(far), runs, serial))

        return F.aggregate(places, start, step, finish)

    hex_letters = [(c, 1 / 16) for c in _ALPHABET["hex"]]
    base32 = [(_ALPHABET["base32"][i : i + 4], 4 / 32) for i in range(0, 32, 4)]
    rare = "".join(c for c in "abcdefghijklmnopqrstuvwxyz" if c not in _COMMON)
    base64 = [
        (_COMMON, len(_COMMON) / 64),
        (rare, len(rare) / 64),
        (_COMMON.upper(), len(_COMMON) / 64),
        (rare.upper(), len(rare) / 64),
        ("0123456789+/", 12 / 64),
    ]
    return (
        F.when(token.rlike("^[0-9]+$"), F.lit(None).cast("double"))
        .when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), tests(_ALPHABET["hex"], lower, hex_letters))
        .when(token.rlike("^[A-Z2-7]+$"), tests(_ALPHABET["base32"], token, base32))
        .otherwise(tests(_ALPHABET["base64"], F.translate(token, "-_", "+/"), base64))
    )


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` (base spans) and ``_tested`` (tested tokens:
    span, step of the p-value, length class)."""
    text = whole_text()
    base = F.concat(_spans(text, ASSIGN, 0, LEAST_VALUE), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    with_base = docs.withColumn("_base", base)
    tokens = _spans(text, TOKEN, 3)
    free = F.filter(
        tokens,
        lambda t: ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )

    def tested(span: Column) -> Column:
        token = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        p = _p_value(token)
        size = (span["end"] - span["start"]).cast("double")
        return F.struct(
            span.alias("span"),
            F.floor(p * STEPS).cast("int").alias("step"),
            F.least(F.floor(2 * F.log2(size)), F.lit(16)).cast("int").alias("size"),
        )

    found = F.when(text.rlike(TOKEN), F.filter(F.transform(free, tested), lambda t: t["step"].isNotNull()))
    none = F.array().cast("array<struct<span:struct<start:int,kind:int,end:int>,step:int,size:int>>")
    return with_base.withColumn("_tested", F.coalesce(found, none))


def limits(found: DataFrame) -> dict[int, int]:
    """Per length class, of which there are at most 17, the least step at which
    tokens are accepted."""
    counts = found.select(F.explode("_tested").alias("t")).groupBy("t.size", "t.step").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("size").orderBy(F.desc("step"))
    whole = Window.partitionBy("size")
    accepted = F.sum("n").over(above)
    random = 2 * F.sum(F.when(F.col("step") >= STEPS // 2, F.col("n")).otherwise(0)).over(whole)
    ordinary = accepted - random * (STEPS - F.col("step")) / STEPS
    counts = counts.select("size", "step", (ordinary / accepted <= RATE).alias("fine"))
    rows = counts.where("fine").groupBy("size").agg(F.min("step").alias("least")).collect()
    return {r["size"]: r["least"] for r in rows}


def with_spans(found: DataFrame, least: dict[int, int]) -> DataFrame:
    """``_spans``: all spans of each row of ``found``, sorted by start and kind."""
    accepted = F.lit(False)
    if least:
        known = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
        spans = F.filter("_tested", lambda t: F.coalesce(t["step"] >= F.try_element_at(known, t["size"]), accepted))
    else:
        spans = F.filter("_tested", lambda t: accepted)
    random = F.transform(spans, lambda t: t["span"])
    return found.withColumn("_spans", F.array_sort(F.concat("_base", random))).drop("_tested")


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(shown, ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access,
    n_hex, base_sha256, spans (kind:start:end by start, then kind; code points,
    end exclusive).

    A null or empty text has no spans. doc_id may be null or repeat; other
    columns are ignored. An assignment's span is its whole match. Tokens that
    overlap a base span are not tested.
    """
    found = saved(scanned(docs.select("doc_id", "text")).drop("text"), "secrets")
    rows = with_spans(found, limits(found))

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        F.col("doc_id").cast("long"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.array_sort("_base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("_spans")).alias("spans"),
    )


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with each stretch of secrets in ``text`` replaced by ``MASK``;
    other rows and columns, whatever their names, stay as they are. Null and
    empty texts stay; repeated rows are masked alike."""
    # The limits come from all tokens; the texts are scanned again rather than shuffled.
    found = saved(scanned(docs.select("doc_id", "text")).select("_tested"), "tested")
    # The row is carried as one value, so its columns' names cannot clash.
    whole = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = with_spans(scanned(whole), limits(found))
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        new = span["start"] >= done["at"]
        # A span that begins inside the one before continues it.
        between = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        out = F.when(new, F.concat(done["out"], between, F.lit(MASK))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    masked = F.aggregate(
        "_spans", start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    )
    shown = {c: F.col(f"_row.`{c}`") for c in docs.columns}
    shown["text"] = F.when(F.size("_spans") > 0, masked).otherwise(text)
    if "n_chars" in shown:
        shown["n_chars"] = F.when(F.size("_spans") > 0, F.length(masked).cast("long")).otherwise(shown["n_chars"])
    return rows.select(*[c.alias(n) for n, c in shown.items()])
