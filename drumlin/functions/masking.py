"""Keyed tokens in place of ids: HMAC-SHA256, from built-in functions."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = "inner binary, outer binary"
#: Hexadecimal digits of a token: 128 bits, so that 10^12 ids share none but with probability 10^-15.
DIGITS = 32
_BLOCK = 64


def keys(spark: SparkSession, secret: bytes) -> DataFrame:
    """The secret as a table of one row, to be kept where only the masking job reads it. Tokens take it
    from that row by a subquery, so it stands in no plan, explanation or event log."""
    if not secret:
        raise ValueError("an empty secret masks nothing")
    block = (hashlib.sha256(secret).digest() if len(secret) > _BLOCK else secret).ljust(_BLOCK, b"\0")
    row = (bytearray(x ^ 0x36 for x in block), bytearray(x ^ 0x5C for x in block))
    return spark.createDataFrame([row], KEYS)


def token(kind: str, value: Column, key: DataFrame) -> Column:
    """HMAC of ``kind``, a zero byte and the id's UTF-8; null stays null. The same id of the same kind has the same token
    in every table and run under one key; kinds differ, so a device named as a user is not seen to be one."""
    inner, outer = (key.select(side).scalar() for side in ("inner", "outer"))
    message = F.concat(F.encode(F.lit(f"{kind}\0"), "UTF-8"), F.encode(value.cast("string"), "UTF-8"))
    first = F.unhex(F.sha2(F.concat(inner, message), 256))
    return F.left(F.sha2(F.concat(outer, first), 256), F.lit(DIGITS))


def masked(rows: DataFrame, key: DataFrame, ids: Mapping[str, str]) -> DataFrame:
    """The rows with tokens in the columns of ``ids``, which maps a column to its kind of id."""
    return rows.withColumns({column: token(kind, F.col(f"`{column}`"), key) for column, kind in ids.items()})
