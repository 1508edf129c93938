"""Decimal columns inside change events: as text or as base64 bytes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

TWO_POW_64 = "18446744073709551616"
TWO_POW_63 = "9223372036854775808"
# Fixed pattern: sign bytes that a shortest two's-complement form leaves out.
SPARE_SIGN_BYTES = r"^(?:(?:00(?=[0-7]))+|(?:FF(?=[89A-F]))+)"


def decimal_text(c: Column, dtype: T.DecimalType | None = None) -> Column:
    """The exact decimal text, trailing zeros kept.

    With ``dtype`` it is plain under every session setting: without ANSI mode
    a cast writes small values with an exponent.
    """
    text = c.cast("string")
    if dtype is None:
        return text
    # The unscaled digits are those before the exponent, without point and sign.
    digits = F.regexp_replace(text, "E.*$|[.-]", "")
    digits = F.lpad(digits, dtype.scale + 1, "0")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    plain = F.concat(sign, F.lit("0."), F.substring(digits, 2, dtype.scale))
    return F.when(F.contains(text, F.lit("E")), plain).otherwise(text)


def decimal_bytes(c: Column, dtype: T.DecimalType) -> Column:
    """Base64 of the shortest big-endian two's-complement unscaled integer.

    12345 gives ``MDk=``. Stays in built-in expressions for every precision:
    up to 18 digits the unscaled value fits one BIGINT, wider values are cut
    into a high and a low 64-bit word.
    """
    digits = F.regexp_replace(decimal_text(c, dtype), r"\.", "")
    if dtype.precision <= 18:
        word_hex = F.lpad(F.hex(digits.cast("bigint")), 16, "0")
    else:
        negative = digits.startswith("-")
        # |u| - 1 is the bitwise complement of a negative u, so both words can
        # be computed on a non-negative number and flipped afterwards. The sign
        # comes off the text: Spark rounds when it negates 35 digits and more.
        absolute = F.regexp_replace(digits, "-", "").cast("decimal(38,0)")
        magnitude = (absolute - negative.cast("int")).cast("decimal(38,0)")
        modulus = F.lit(TWO_POW_64).cast("decimal(20,0)")
        low_part = (magnitude % modulus).cast("decimal(20,0)")
        high = ((magnitude - low_part) / modulus).cast("bigint")
        low = (
            F.when(low_part >= F.lit(TWO_POW_63).cast("decimal(20,0)"), low_part - modulus)
            .otherwise(low_part)
            .cast("bigint")
        )
        words = [F.when(negative, F.bitwise_not(w)).otherwise(w) for w in (high, low)]
        word_hex = F.concat(*[F.lpad(F.hex(w), 16, "0") for w in words])
    return F.base64(F.unhex(F.regexp_replace(word_hex, SPARE_SIGN_BYTES, "")))


def encode_decimal(c: Column, dtype: T.DataType, mode: str = "string") -> Column:
    """The event representation of a column; other types pass unchanged.

    ``mode="string"`` keeps a decimal as text, ``mode="precise"`` writes its
    unscaled bytes as base64.
    """
    if mode not in ("string", "precise"):
        raise ValueError(f"decimal mode must be 'string' or 'precise', not {mode!r}")
    if not isinstance(dtype, T.DecimalType):
        return c
    return decimal_text(c, dtype) if mode == "string" else decimal_bytes(c, dtype)
