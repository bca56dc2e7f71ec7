"""Readers and writers of corpus files, chunks, shards and small lists."""

from __future__ import annotations

import json
from functools import reduce
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.text import blank_to, first_of_list, first_truthy, normalize_text
from chunkloom.operators.sharding import cap_per_group
from chunkloom.schema import CHUNK_COLUMNS, MANIFEST, canonical, struct
from chunkloom.sources import fs

#: Names under which raw corpora carry the same field.
ALIASES = {
    "content": ("content", "text"),
    "repo_name": ("max_stars_repo_name", "repository_name", "repo_name"),
    "path": ("max_stars_repo_path", "path", "filename"),
}
LICENSE_ALIASES = ("detected_licenses", "max_stars_repo_licenses", "license")
CORPUS_COLUMNS = ("content", "repo_name", "path", "language", "license")
PART_ROWS = 50_000


class MissingInput(FileNotFoundError):
    """No input where some is required; the command line ends with code 2."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project_raw(df: DataFrame, language: str | None = None) -> DataFrame:
    """Raw corpus rows to content, repo_name, path, language, license: the first alias that is neither null nor empty;
    of a list of licences the first one."""

    def pick(names: tuple[str, ...]):
        there = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
        return first_truthy(*there) if there else F.lit("")

    licences = []
    for n in LICENSE_ALIASES:
        if n in df.columns:
            c = F.col(f"`{n}`")
            licences.append(first_of_list(c) if df.schema[n].dataType.typeName() == "array" else blank_to(c.cast("string")))
    lang = F.lit(language) if language is not None else blank_to(F.col("language").cast("string")) if "language" in df.columns else F.lit("")
    return df.select(*[pick(a).alias(n) for n, a in ALIASES.items()], lang.alias("language"), (first_truthy(*licences) if licences else F.lit("")).alias("license"))


def read_corpus(spark: SparkSession, root: str, languages: list[str] | None = None) -> DataFrame:
    """Staged files below root/lang=<language>/, or those of a glob; the folder column only prunes and goes again."""
    try:
        reader = spark.read.option("pathGlobFilter", "*.parquet")
        df = (reader if any(c in root for c in "*?[{") else reader.option("basePath", root)).parquet(root)
    except AnalysisException as e:
        raise MissingInput(root) from e
    if "lang" in df.columns and languages is not None:
        df = df.where(F.col("lang").isin(languages))
    return df.drop("lang")


def stage_corpus(raw: DataFrame, root: str, languages: list[str], cap: int = 0, order: list[str] | None = None) -> None:
    """Writes the projected rows of the languages as zstd Parquet, at most PART_ROWS a file; a staged root is left as it is."""
    spark = raw.sparkSession
    if is_staged(spark, root):
        return
    rows = project_raw(raw).where(F.col("language").isin(languages))
    rows = cap_per_group(rows, "language", cap, order or ["repo_name", "path", "content"])
    rows.withColumn("lang", F.col("language")).write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", PART_ROWS).partitionBy("lang").parquet(root)
    check_corpus(read_corpus(spark, root))
    mark_staged(spark, root, {"languages": languages, "cap": cap})


def stage_eval_pack(spark: SparkSession, sources: dict[str, str], root: str) -> list[str]:
    """Copies corpus, queries, qrels and pair tables to Parquet; a source that fails is only reported, the marker is written."""
    failed = []
    for name, path in sources.items():
        try:
            spark.read.format("json" if path.endswith((".json", ".jsonl")) else "parquet").load(path).write.mode("overwrite").parquet(f"{root}/{name}")
        except AnalysisException:
            failed.append(name)
    mark_staged(spark, root, {"failed": failed})
    return failed


def mark_staged(spark: SparkSession, root: str, facts: dict) -> None:
    """A marker beside the data."""
    fs.write_bytes(spark, f"{root}/_STAGED.json", json.dumps(facts, sort_keys=True).encode())


def is_staged(spark: SparkSession, root: str) -> bool:
    return fs.exists(spark, f"{root}/_STAGED.json")


def quality(df: DataFrame) -> DataFrame:
    """One row of the checks on staged files: row count and whether any content, repository and licence is not blank."""

    def some(name: str):
        return F.coalesce(F.bool_or(F.coalesce(normalize_text(F.col(name)), F.lit("")) != ""), F.lit(False)).alias(f"any_{name}")

    return df.agg(F.count("*").alias("n_rows"), some("content"), some("repo_name"), some("license"))


def check_corpus(df: DataFrame) -> None:
    """Raises ValueError where columns are missing, there are no rows, or a required column is blank throughout."""
    if missing := [c for c in CORPUS_COLUMNS if c not in df.columns]:
        raise ValueError(f"the corpus lacks {', '.join(missing)}")
    got = quality(df).first().asDict()
    if bad := [k for k, v in got.items() if not v]:
        raise ValueError(f"the corpus fails {', '.join(bad)}")


def read_chunks(spark: SparkSession, root: str, languages: list[str] | None = None) -> DataFrame:
    """Chunk rows below root in the chunk schema; languages without files are simply absent."""
    try:
        df = spark.read.schema(struct(CHUNK_COLUMNS)).parquet(root)
    except AnalysisException as e:
        raise MissingInput(root) from e
    return canonical(df if languages is None else df.where(F.col("language").isin(languages)), CHUNK_COLUMNS)


def write_partitioned(df: DataFrame, root: str, *by: str, rows_per_file: int = 0, mode: str = "overwrite") -> None:
    """zstd Parquet partitioned by copies of columns (lang=...), so that the columns stay in the files too."""
    out = df
    for b in by:
        out = out.withColumn(f"_{b}" if b != "language" else "lang", F.col(b))
    names = ["lang" if b == "language" else f"_{b}" for b in by]
    writer = out.write.mode(mode).option("compression", "zstd")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*names).parquet(root)


def write_manifest(df: DataFrame, root: str) -> None:
    """JSON lines by shard id in one file; a manifest has a row per shard, so it is small."""
    df.orderBy("shard_id").coalesce(1).write.mode("overwrite").json(root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest by its schema; absent keys get their defaults; blank lines are skipped."""
    try:
        df = spark.read.schema(MANIFEST).json(root)
    except AnalysisException as e:
        raise MissingInput(root) from e
    rows = df.where("shard_id is not null")
    return rows.select("shard_id", *[blank_to(F.col(c)).alias(c) if c != "status" else blank_to(F.col(c), "pending").alias(c) for c in ("language",)], F.coalesce("input_files", F.array().cast("array<string>")).alias("input_files"), F.coalesce("approx_chunks", F.lit(0)).alias("approx_chunks"), blank_to(F.col("out_parquet")).alias("out_parquet"), blank_to(F.col("out_npy")).alias("out_npy"), blank_to(F.col("status"), "pending").alias("status"))


def get_shard(shards: DataFrame, shard_id: int) -> DataFrame:
    """The one row of a shard; KeyError where there is none."""
    one = shards.where(F.col("shard_id") == shard_id)
    if one.isEmpty():
        raise KeyError(f"shard {shard_id}")
    return one


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """(repo_name) of a text list, trimmed, without blank lines and repeats; a missing file is an empty list."""
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], "repo_name string")
    return lines.select(normalize_text(F.col("value")).alias("repo_name")).where("repo_name <> ''").distinct()


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_id) of an append-only log with one id a line; a last line without line feed is torn and dropped."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "chunk_id string")
    lines = F.split("value", "\n")
    complete = F.slice(lines, 1, F.size(lines) - 1)  # what follows the last line feed is torn or empty
    return whole.select(F.explode(complete).alias("chunk_id")).select(F.trim("chunk_id").alias("chunk_id")).where("chunk_id <> ''").distinct()


def read_batches(path: str) -> list[tuple[str, list[str]]]:
    """(run name, languages) of a batch list: one run a line, # begins a comment."""
    out = []
    for line in Path(path).read_text().splitlines():
        parts = line.split("#")[0].split()
        if parts:
            out.append((parts[0], [x for x in ",".join(parts[1:]).split(",") if x]))
    return out


def union(*dfs: DataFrame) -> DataFrame:
    """Union by name; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
