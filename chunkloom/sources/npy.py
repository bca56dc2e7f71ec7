"""Vector files: a Spark data source `npy` that reads and writes two-dimensional NumPy arrays, and named files of shards.

Reading gives (path, row, vector) and splits large files by rows; writing gives files per task, committed by
renaming.  Options: path; rows (rows per read task or per written file); dtype (float32 or float16, for writing).
Files lie wherever pyarrow's file systems reach: local and mounted folders, HDFS, object stores.
"""

from __future__ import annotations

import glob
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "path string, row int, vector array<float>"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _header(f) -> tuple[tuple[int, ...], np.dtype, int]:
    """(shape, number format, position of the first number) by a file's header."""
    version = np.lib.format.read_magic(f)
    shape, fortran, dtype = np.lib.format.read_array_header_1_0(f) if version == (1, 0) else np.lib.format.read_array_header_2_0(f)
    if fortran:
        raise ValueError("columns first")
    return shape, dtype, f.tell()


def header(rows: int, dim: int, dtype: np.dtype) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": np.lib.format.dtype_to_descr(dtype), "fortran_order": False, "shape": (rows, dim)})
    return out.getvalue()


def shape_of(path: str) -> tuple[int, int] | None:
    """Rows and columns by the header alone; None for missing, damaged and not two-dimensional files."""
    f_system, at = file_system(path)
    try:
        with f_system.open_input_file(at) as f:
            shape, dtype, begin = _header(f)
            whole = f.size() >= begin + int(np.prod(shape)) * dtype.itemsize
    except (OSError, ValueError, EOFError):
        return None
    return shape if len(shape) == 2 and whole else None


def files_below(path: str) -> list[str]:
    """The npy files of a folder at any depth, or those of a file or a local pattern, sorted."""
    f_system, at = file_system(path)
    info = f_system.get_file_info(at)
    scheme = path[: path.index("://") + 3] if "://" in path else ""
    if info.type == pafs.FileType.Directory:
        found = [i.path for i in f_system.get_file_info(pafs.FileSelector(at, recursive=True)) if i.type == pafs.FileType.File]
        return sorted(scheme + p for p in found if p.endswith(".npy") and not p.rsplit("/", 1)[-1].startswith("."))
    return [path] if info.type == pafs.FileType.File else sorted(glob.glob(at))


@dataclass
class Slice(InputPartition):
    path: str
    first: int
    last: int


class NpyReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("rows", 100_000))

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for f in files_below(self.path):
            shape = shape_of(f)
            if shape is None:
                raise ValueError(f"{f} is no matrix")
            out += [Slice(f, a, min(a + self.rows, shape[0])) for a in range(0, shape[0], self.rows)]
        return out

    def read(self, part: Slice):
        f_system, at = file_system(part.path)
        with f_system.open_input_file(at) as f:
            (_, dim), dtype, begin = _header(f)
            for a in range(part.first, part.last, 4096):
                n = min(4096, part.last - a)
                x = np.frombuffer(f.read_at(n * dim * dtype.itemsize, begin + a * dim * dtype.itemsize), dtype).astype(np.float32)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, max(1, dim), dtype=np.int32)), pa.array(x))
                yield pa.RecordBatch.from_arrays([pa.array([part.path] * n), pa.array(np.arange(a, a + n, dtype=np.int32)), vectors], ["path", "row", "vector"])


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # (temporary, final)


def _numbers(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """The matrix of a list column; ValueError where a vector is null or of another width."""
    if column.null_count:
        raise ValueError("a vector is null")
    widths = np.unique(np.diff(column.offsets.to_numpy()))
    if len(widths) > 1:
        raise ValueError("vectors of different widths")
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


class NpyWriter(DataSourceArrowWriter):
    """Rows must have a column `vector`; a task's rows keep their order.  A file has at most `rows` of them."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.dtype, self.rows, self.overwrite = options["path"], np.dtype(options.get("dtype", "float32")), int(options.get("rows", 100_000)), overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        f_system, root = file_system(self.path)
        task, made, waiting, n = TaskContext.get().partitionId(), [], [], 0

        def flush() -> None:
            nonlocal waiting, n
            if n:
                f_system.create_dir(root, recursive=True)
                temporary = f"{root}/.{uuid.uuid4().hex}.npy"
                with f_system.open_output_stream(temporary) as out:
                    out.write(header(n, waiting[0].shape[1], self.dtype))
                    for x in waiting:
                        out.write(x.tobytes())
                made.append((temporary, f"{root}/part-{task:05d}-{len(made):03d}.npy"))
            waiting, n = [], 0

        for batch in batches:
            x = _numbers(batch.column(batch.schema.get_field_index("vector")), self.dtype)
            for a in range(0, len(x), self.rows):
                part = x[a : a + self.rows]
                if n and n + len(part) > self.rows:
                    flush()
                waiting.append(part)
                n += len(part)
        flush()
        return Written(made)

    def commit(self, messages: list) -> None:
        new = [f for m in messages if m for f in m.files]
        f_system, root = file_system(self.path)
        if self.overwrite and f_system.get_file_info(root).type == pafs.FileType.Directory:
            for i in f_system.get_file_info(pafs.FileSelector(root)):
                if i.base_name.startswith("part-") and i.base_name.endswith(".npy"):
                    f_system.delete_file(i.path)
        for temporary, final in new:
            f_system.move(temporary, final)

    def abort(self, messages: list) -> None:
        f_system, _ = file_system(self.path)
        for temporary, _ in (f for m in messages if m for f in m.files):
            if f_system.get_file_info(temporary).type == pafs.FileType.File:
                f_system.delete_file(temporary)


class NpySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> NpyReader:
        return NpyReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> NpyWriter:
        return NpyWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NpySource)


def write_files(df: DataFrame, root: str, dtype: str = "float32") -> DataFrame:
    """Writes rows (file, row, vector) as root/file, row by row from 0, and gives (file, rows) of what was written.

    A file's rows are one task's, sorted by number, and go to the file batch by batch; a file appears under its name
    only when it is whole.  Row numbers that repeat or leave a gap, null vectors and vectors of another width are errors.
    """
    number = np.dtype(dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f_system, base = file_system(root)
        name, out, temporary, at, total, dim = None, None, "", 0, 0, 0

        def finish() -> Iterator[pa.RecordBatch]:
            if out is not None:
                out.close()
                if at != total:
                    raise ValueError(f"{name} has {at} of {total} rows")
                f_system.move(temporary, f"{base}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at], pa.int64())], ["file", "rows"])

        for batch in batches:
            files, rows, counts = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            edge = np.flatnonzero(np.concatenate(([True], files[1:] != files[:-1]))) if len(files) else []
            for a, b in zip(edge, np.append(edge[1:], len(files)) if len(edge) else []):
                x = _numbers(batch.column(2).slice(a, b - a), number)
                if files[a] != name:
                    yield from finish()
                    name, at, total, dim = files[a], 0, int(counts[a]), x.shape[1]
                    folder = f"{base}/{name}".rsplit("/", 1)[0]
                    f_system.create_dir(folder, recursive=True)
                    temporary = f"{folder}/.{uuid.uuid4().hex}.npy"
                    out = f_system.open_output_stream(temporary)
                    out.write(header(total, dim, number))
                if x.shape[1] != dim or not np.array_equal(rows[a:b], np.arange(at, at + b - a)):
                    raise ValueError(f"{name}: rows out of order or of another width")
                out.write(x.tobytes())
                at += b - a
        yield from finish()

    counts = df.groupBy("file").agg(F.count("*").alias("n"))
    told = df.select("file", F.col("row").cast("int").alias("row"), "vector").join(counts, "file").select("file", "row", "vector", "n")
    return told.repartition("file").sortWithinPartitions("file", "row").mapInArrow(run, "file string, rows bigint")
