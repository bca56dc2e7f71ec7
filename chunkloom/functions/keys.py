"""Content keys and hash buckets.

hash_fn "blake2b" is the engine's key (an Arrow batch function, as Spark has no blake2b); "md5" is a JVM
expression with the same shape, which SQL engines can check.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from chunkloom.functions.text import normalize_text
from chunkloom.schema import EVAL_TEST, EVAL_VALID, INDEX_ONLY

_MASK = 0x7FFF_FFFF_FFFF_FFFF
_HEX16 = re.compile(r"[0-9a-fA-F]{16}")


def blake2b_hex(text: str, size: int) -> str:
    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=size).hexdigest()


@F.pandas_udf(StringType())
def _blake16(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else blake2b_hex(t, 16))


@F.pandas_udf(StringType())
def _blake8(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else blake2b_hex(t, 8))


def _check(hash_fn: str) -> None:
    if hash_fn not in ("blake2b", "md5"):
        raise ValueError(f"hash_fn {hash_fn!r}")


def chunk_id(text: Column, repo: Column, path: Column, start: Column, end: Column, hash_fn: str = "blake2b") -> Column:
    """32 hexadecimal digits of the normalized text, repository, path and lines, separated by NUL."""
    _check(hash_fn)
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (normalize_text(text), repo, path, start, end)]
    joined = F.concat_ws("\0", *parts)
    return F.md5(joined) if hash_fn == "md5" else _blake16(joined)


def int64_of_hex(c: Column) -> Column:
    """The first 16 digits as a number without its sign bit; null where they are not hexadecimal."""
    return F.when(c.rlike("^[0-9a-fA-F]{16}"), F.conv(F.substring(c, 1, 16), 16, -10).cast("bigint").bitwiseAND(F.lit(_MASK)))


@F.pandas_udf(LongType())
def _int64_any(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else int(t[:16] if _HEX16.match(t) else blake2b_hex(t, 8), 16) & _MASK).astype("Int64")


def chunk_int64(c: Column, only_hex: bool = False) -> Column:
    """63-bit key of an id; ids that are not hexadecimal are hashed first (only_hex: they give null, in the JVM)."""
    return int64_of_hex(c) if only_hex else _int64_any(c)


def bucket(key: Column, seed: int, buckets: int = 1000, hash_fn: str = "blake2b") -> Column:
    """A stable bucket of 0..buckets-1 from "seed:key"."""
    _check(hash_fn)
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(key, F.lit("")))
    digest = F.md5(salted) if hash_fn == "md5" else _blake8(salted)
    return (F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(buckets)).cast("int")


def eval_split(slot: Column, listed: Column, list_is_empty: Column, valid: float = 0.05, test: float = 0.05, buckets: int = 1000) -> Column:
    """A listed repository is tested; else the bucket decides, the test slots only where there is no list."""
    v, t = int(valid * buckets), int(test * buckets)
    return (
        F.when(listed, EVAL_TEST).when(slot < v, EVAL_VALID).when(list_is_empty & (slot < v + t), EVAL_TEST).otherwise(INDEX_ONLY)
    )
