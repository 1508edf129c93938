"""Decimals as text and bytes do not depend on session settings."""

import base64
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from rowtide.functions.decimals import encode_decimal

VALUES = ["0", "0.0000001", "-0.0000001", "-12.5", "12345.6789", "-0.5"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("dtype", [T.DecimalType(12, 7), T.DecimalType(38, 10)])
def test_plain_text_and_exact_bytes(spark, ansi, dtype):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = [Decimal(v).quantize(Decimal(1).scaleb(-dtype.scale)) for v in VALUES] + [None]
        rows = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))
        text = encode_decimal(F.col("v"), dtype).alias("t")
        packed = encode_decimal(F.col("v"), dtype, "precise").alias("b")
        for v, r in zip(values, rows.select(text, packed).collect()):
            if v is None:
                assert r.t is None and r.b is None
                continue
            assert r.t == format(v, "f")
            unscaled = int(v.scaleb(dtype.scale))
            assert int.from_bytes(base64.b64decode(r.b), "big", signed=True) == unscaled
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
