"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.operators.partitions import spread  # noqa: F401  (for the operators)
from chunkloom.operators.sharding import reliable as checkpointed  # noqa: F401

#: A token: a run of ASCII letters, digits and underscores, or any other single character but ASCII white space.
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r\f\v]"
#: A word: a run of Unicode letters or digits, to be lower-cased.
WORD = r"[^\W_]+"

TOKEN_RE = re.compile(TOKEN)
WORD_RE = re.compile(WORD)


def words(text: str) -> list[str]:
    """The lower-cased words of a text."""
    return WORD_RE.findall(text.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables: a Parquet file or a folder of them."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str) -> DataFrame:
    """mapInArrow of a function on single batches; the batches' size follows Spark's byte limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from out.to_batches() if isinstance(out, pa.Table) else (out,)

    return df.mapInArrow(run, schema)


def blocks_folded(parts: DataFrame, fold: Callable[[list[bytes]], bytes], last: Callable[[bytes], bytes] = bytes, steps: int = 2) -> Iterator[tuple[int, bytes]]:
    """(block, data) of (block int, data binary) rows of many tasks, folded into one for each block, last applied to it.

    It takes two steps, so that no group holds a block of every task of a very large input; the data travel compressed.
    One step is enough for parts that hold only what a task has; it is over in the cluster before the driver reads.
    The blocks reach the driver one after another.
    """

    def step(end: Callable[[bytes], bytes]) -> Callable[[pa.Table], pa.Table]:
        def run(t: pa.Table) -> pa.Table:
            data = end(fold([zlib.decompress(x.as_py()) for x in t.column("data")]))
            return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int32()), "data": pa.array([zlib.compress(data, 1)], pa.binary())})

        return run

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([zlib.compress(x.as_py(), 1) for x in batch.column(1)], pa.binary())], ["block", "data"])

    schema = "block int, data binary"
    rows = map_arrow(parts, pack, schema)
    if steps == 2:
        rows = rows.withColumn("of", F.spark_partition_id() % 128).groupBy("block", "of").applyInArrow(step(bytes), schema)
    rows = rows.groupBy("block").applyInArrow(step(last), schema)
    if steps == 1:
        rows = checkpointed(rows)
    for r in rows.toLocalIterator():
        yield r.block, zlib.decompress(r.data)


#: Bits of a bitmap of hashes: 16 for each within these bounds (128 MB at most), in blocks of so many bytes.
LEAST_BITS, MAX_BITS, BLOCK_BYTES = 1 << 20, 1 << 30, 1 << 16


def bitmap(hashes: DataFrame, count: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """The bits of all hashes of a bigint column, eight to a byte; a full bitmap lets more through, never less.

    Tasks pass on the blocks that they touch.
    """
    bits = min(max_bits, max(LEAST_BITS, 1 << (16 * max(1, count) - 1).bit_length()))

    def run(batches):
        out = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            at = np.unique(batch.column(0).to_numpy().view(np.uint64) & np.uint64(bits - 1)).astype(np.int64)
            byte, bit = at >> 3, (128 >> (at & 7)).astype(np.uint8)
            first = np.flatnonzero(np.concatenate(([True], byte[1:] != byte[:-1])))
            out[byte[first]] |= np.bitwise_or.reduceat(bit, first)
        for b in range(-(-len(out) // BLOCK_BYTES)):
            part = out[b * BLOCK_BYTES : (b + 1) * BLOCK_BYTES]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "data"])

    def either(parts: list[bytes]) -> bytes:
        return np.bitwise_or.reduce([np.frombuffer(p, np.uint8) for p in parts]).tobytes()

    out = np.zeros(bits // 8, np.uint8)
    for block, data in blocks_folded(hashes.mapInArrow(run, "block int, data binary"), either):
        out[block * BLOCK_BYTES : (block + 1) * BLOCK_BYTES] = np.frombuffer(data, np.uint8)
    return out


def in_bitmap(there: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a bitmap may hold."""
    at = (hashes & np.uint64(8 * len(there) - 1)).astype(np.int64)
    return (there[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def sifted(df: DataFrame, key: str, there: np.ndarray) -> DataFrame:
    """The rows whose bigint key a bitmap may hold: what is not asked for stays out of the shuffle that follows."""
    shared = df.sparkSession.sparkContext.broadcast(there)
    at = df.columns.index(key)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(shared.value, batch.column(at).to_numpy().view(np.uint64))))

    return df.mapInArrow(run, df.schema)


def blank(c: Column) -> Column:
    """True for null and for white space only."""
    return F.coalesce(F.length(F.trim(F.regexp_replace(c, r"\s+", " "))) == 0, F.lit(True))
