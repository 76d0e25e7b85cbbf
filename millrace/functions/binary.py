"""Decoding of binary strings as column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def byte_at(data: Column, n: Column | int) -> Column:
    """Value 0..255 of byte ``n``, counted from 1."""
    pos = F.lit(n) if isinstance(n, int) else n
    return F.conv(F.hex(F.substring(data, pos, F.lit(1))), 16, 10).cast("int")


def bits_from_bytes(data: Column) -> Column:
    """Bits of every byte, lowest bit first: ``X'9100'`` -> ``1000100100000000``."""
    one_byte = lambda i: F.reverse(F.lpad(F.bin(byte_at(data, i).cast("long")), 8, "0"))
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.octet_length(data)), one_byte))
    return F.when(F.octet_length(data) > 0, text).when(data.isNotNull(), F.lit(""))


def int_from_2_bytes(data: Column, n: int = 1) -> Column:
    """Unsigned 16-bit number stored low byte first at byte ``n``: ``X'D204'`` -> 1234."""
    return byte_at(data, n) + byte_at(data, n + 1) * 256


def int_to_binary(value: Column, size: int = 2) -> Column:
    """High byte first, cut to ``size`` bytes: 1234 -> ``X'04D2'``."""
    digits = F.lpad(F.hex(value.cast("long")), max(16, 2 * size), "0")
    return F.unhex(F.right(digits, F.lit(2 * size)))


def register_sql_functions(spark: SparkSession) -> None:
    """The two decoders as SQL functions of the session."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION bits_from_bytes(data BINARY) RETURNS STRING
        RETURN CASE WHEN octet_length(data) > 0 THEN array_join(transform(
            sequence(1, octet_length(data)),
            i -> reverse(lpad(bin(cast(conv(hex(substring(data, i, 1)), 16, 10) AS BIGINT)), 8, '0'))
        ), '') WHEN data IS NOT NULL THEN '' END""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION int_from_2_bytes(data BINARY, n INT) RETURNS INT
        RETURN cast(conv(concat(hex(substring(data, n + 1, 1)), hex(substring(data, n, 1))), 16, 10) AS INT)""")
