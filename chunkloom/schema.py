"""The one row schema of the engine: chunk columns, embedding columns, their order and their defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """A column: its name, Spark type, stage (chunk or embed), default and meaning."""

    name: str
    kind: str
    stage: str
    default: object
    note: str


#: The contract of column names, types, order and defaults.
FIELDS: tuple[Field, ...] = (
    Field("chunk_id", "string", "chunk", "", "content hash, primary key, never null"),
    Field("repo_name", "string", "chunk", "", "source repository"),
    Field("path", "string", "chunk", "", "file within the repository"),
    Field("language", "string", "chunk", "", "programming language"),
    Field("license", "string", "chunk", "", "SPDX id of the file's licence"),
    Field("text_publishable", "boolean", "chunk", False, "licence allows the text to be published"),
    Field("symbol_kind", "string", "chunk", "whole_file", "function, method, class, window or whole_file"),
    Field("symbol_name", "string", "chunk", "", "name of the symbol"),
    Field("start_line", "int", "chunk", 0, "first line, from 1"),
    Field("end_line", "int", "chunk", 0, "last line"),
    Field("n_tokens", "int", "chunk", 0, "tokens of the text"),
    Field("truncated", "boolean", "chunk", False, "one window of a longer span"),
    Field("text", "string", "chunk", "", "the code"),
    Field("query_text", "string", "chunk", "", "natural-language query, empty if none"),
    Field("query_source", "string", "chunk", "none", "docstring, codesearchnet, coir, commit or none"),
    Field("eval_split", "string", "chunk", "index_only", "index_only, eval_test or eval_valid"),
    Field("vector_shard", "string", "embed", "", "file that holds the vector"),
    Field("row_in_shard", "int", "embed", 0, "row of the vector in that file"),
    Field("embedding", "array<float>", "inline", None, "the vector, only if kept inline"),
    Field("model_id", "string", "embed", "", "embedding model"),
    Field("model_revision", "string", "embed", "", "its revision"),
    Field("embed_dim", "int", "embed", 0, "dimensions"),
    Field("pooling", "string", "embed", "last_token", "pooling of the model"),
    Field("normalized", "boolean", "embed", True, "unit length"),
    Field("dtype", "string", "embed", "", "number format of the computation"),
    Field("corpus_snapshot", "string", "chunk", "", "snapshot of the corpus"),
)
BY_NAME = {f.name: f for f in FIELDS}
CHUNK_COLUMNS = [f.name for f in FIELDS if f.stage == "chunk"]
EMBED_COLUMNS = [f.name for f in FIELDS if f.stage == "embed"]

#: The domains of the coded columns.
SYMBOL_KINDS = ("function", "method", "class", "module", "window", "whole_file")
QUERY_SOURCES = ("docstring", "codesearchnet", "coir", "commit", "none")
INDEX_ONLY, EVAL_TEST, EVAL_VALID = "index_only", "eval_test", "eval_valid"

MANIFEST = "shard_id int, language string, input_files array<string>, approx_chunks int, out_parquet string, out_npy string, status string"
_KINDS = {"string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "array<float>": T.ArrayType(T.FloatType())}


def spark_type(kind: str) -> T.DataType:
    """The Spark type of a declared one; any other name raises ValueError."""
    if kind not in _KINDS:
        raise ValueError(f"unknown column type {kind!r}")
    return _KINDS[kind]


def struct(columns: list[str] | None = None, inline_embedding: bool = False) -> T.StructType:
    """The StructType of the whole row or of some columns, always in canonical order."""
    wanted = set(columns if columns is not None else [f.name for f in FIELDS if f.name != "embedding"])
    if inline_embedding:
        wanted.add("embedding")
    return T.StructType([T.StructField(f.name, spark_type(f.kind), f.name != "chunk_id") for f in FIELDS if f.name in wanted])


def canonical(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Known columns only, in canonical order, cast to their types; strays and partition columns go."""
    wanted = set(columns or [f.name for f in FIELDS])
    return df.select(*[F.col(f"`{f.name}`").cast(spark_type(f.kind)).alias(f.name) for f in FIELDS if f.name in wanted and f.name in df.columns])


def with_defaults(df: DataFrame, snapshot: str = "") -> DataFrame:
    """Fills nulls and adds missing chunk and embed columns with the row defaults; an empty string means absent."""

    def value(f: Field) -> Column:
        default = F.lit(snapshot if f.name == "corpus_snapshot" else f.default).cast(spark_type(f.kind))
        return F.coalesce(F.col(f"`{f.name}`"), default) if f.name in df.columns else default

    return df.withColumns({f.name: value(f) for f in FIELDS if f.stage != "inline"})


def describe() -> list[tuple[str, str, bool, str]]:
    """(name, type, may be null, note) of every column."""
    return [(f.name, f.kind, f.name != "chunk_id", f.note) for f in FIELDS]
