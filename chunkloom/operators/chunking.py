"""Files to chunks: symbol spans or whole files, cut into overlapping windows of tokens where they are too long."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions import text as X
from chunkloom.functions.keys import blake2b_hex
from chunkloom.functions.tokenizers import Tokenizer, by_expression, load
from chunkloom.operators.partitions import spread
from chunkloom.operators.symbols import symbols
from chunkloom.schema import CHUNK_COLUMNS, struct

_SPACES = re.compile(r"\s+")


def sliding_windows(n: int, window: int, overlap: int) -> list[tuple[int, int]]:
    """[start, stop) over n items; the first window that reaches the end is the last."""
    if window <= 0:
        raise ValueError("the window must be positive")
    step, out, at = max(1, window - max(0, overlap)), [], 0
    while at < n:
        out.append((at, min(at + window, n)))
        if at + window >= n:
            break
        at += step
    return out


def content_id(text: str, repo: str, path: str, start: int, end: int) -> str:
    """The key of a chunk; see chunkloom.functions.keys.chunk_id."""
    return blake2b_hex("\0".join((_SPACES.sub(" ", text).strip(), repo, path, str(start), str(end))), 16)


def span_chunks(span: str, kind: str, name: str, line: int, limit: int, overlap: int, least: int, exact: bool = False, tokenizer: Tokenizer = by_expression) -> Iterator[tuple]:
    """(kind, name, first line, last line, tokens, truncated, text, line of the key) of one span.

    Spans that certainly fit are not tokenized unless exact counts are asked for; spans and windows under the
    least size are dropped; windows carry the whole span's lines.
    """
    most, few = max(1, len(span) // 2), len(span) // 5
    last = line + span.count("\n")
    if most < least:
        return
    if not exact and most <= limit and few >= least:
        yield kind, name, line, last, max(least, len(span) // 3), False, span, last
        return
    at = tokenizer(span)
    if len(at) < least:
        return
    if len(at) <= limit:
        yield kind, name, line, last, len(at), False, span, last
        return
    for a, b in sliding_windows(len(at), limit, overlap):
        if b - a >= least:
            yield "window", name, line, last, b - a, True, span[at[a][0] : at[b - 1][1]], line


def file_chunks(text: str, language: str, limit: int = 2048, overlap: int = 64, least: int = 8, unit: str = "symbol", exact: bool = False, tokenizer: Tokenizer = by_expression) -> Iterator[tuple]:
    """The chunks of one file.  A file whose symbols are all too small gives none; one without symbols is one span."""
    found = symbols(text, language) if unit == "symbol" else []
    if found:
        for s in found:
            yield from span_chunks(text[s.start : s.end], s.kind, s.name, s.line, limit, overlap, least, exact, tokenizer)
    else:
        yield from span_chunks(text, "whole_file", "", 1, limit, overlap, least, exact, tokenizer)


def chunk_files(files: DataFrame, allow: list[str], snapshot: str = "", limit: int = 2048, overlap: int = 64, least: int = 8, unit: str = "symbol", exact: bool = False, tokenizer: str = "regex") -> DataFrame:
    """Rows of the chunk schema from files (content, repo_name, path, language, license), one pass without a shuffle.

    Null and empty contents give no chunks; null provenance becomes the empty text; the licence flag is exact
    membership in `allow`.  Columns besides the five are ignored.  The tokenizer is named as in
    chunkloom.functions.tokenizers; it is loaded once per worker.
    """
    schema = struct(CHUNK_COLUMNS)
    target = pa.schema([pa.field(f.name, {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32()}[f.dataType.simpleString()], f.nullable) for f in schema])
    allowed = frozenset(allow)

    def run(batches):
        cut_up = load(tokenizer)
        for batch in batches:
            rows = []
            for content, repo, path, language, license_ in zip(*(c.to_pylist() for c in batch.columns)):
                for kind, name, first, last, n, cut, text, key_line in file_chunks(content, language, limit, overlap, least, unit, exact, cut_up):
                    rows.append((content_id(text, repo, path, first, key_line), repo, path, language, license_, license_ in allowed, kind, name, first, last, n, cut, text, "", "none", "index_only", snapshot))
            cols = list(zip(*rows)) if rows else [[]] * len(target)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, target)], schema=target)

    used = files.select(*[X.blank_to(F.col(c)).alias(c) for c in ("content", "repo_name", "path", "language", "license")])
    return spread(used.where("content <> ''")).mapInArrow(run, schema)


def token_windows(df: DataFrame, id_col: str, text_col: str, window: int, overlap: int) -> DataFrame:
    """(id, win, start, n, text) of sliding token windows as one plan of built-in functions.

    Null and empty texts have no windows; a text within the window has one; the pieces join tokens with one space.
    """
    t = df.select(F.col(id_col).alias("id"), X.tokens(F.col(text_col)).alias("tokens")).withColumn("n", F.size("tokens"))
    starts = t.select("id", "tokens", "n", F.posexplode(X.window_starts(F.col("n"), window, overlap)).alias("win", "start"))
    piece = F.slice("tokens", F.col("start") + 1, window)
    return starts.select("id", F.col("win").cast("int"), F.col("start").cast("int"), F.size(piece).alias("n"), F.concat_ws(" ", piece).alias("text"))
