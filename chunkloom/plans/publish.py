"""The published views of a run and the card that describes them."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.config import Config
from chunkloom.schema import INDEX_ONLY, describe
from chunkloom.sources import fs, npy
from chunkloom.sources.files import write_partitioned

#: More files than this make a repository slow to list.
MANY_FILES = 100_000


def corpus_view(chunks: DataFrame, gate: bool = True) -> DataFrame:
    """The corpus; with the gate, texts whose licence does not allow it are blank, and everything else stays."""
    if not gate:
        return chunks
    return chunks.withColumn("text", F.when(F.coalesce("text_publishable", F.lit(False)), F.col("text")).otherwise(F.lit("")))


def queries_view(chunks: DataFrame) -> DataFrame:
    """Chunks that have a query: chunk_id, query_text, query_source, eval_split, language."""
    return chunks.where("query_text <> ''").select("chunk_id", "query_text", "query_source", "eval_split", "language")


def qrels_view(chunks: DataFrame, strict: bool = False) -> DataFrame:
    """One relevance row per evaluation chunk; strict leaves out those without a query."""
    rows = chunks.where(F.col("eval_split") != INDEX_ONLY)
    rows = rows.where("query_text <> ''") if strict else rows
    return rows.select(F.col("chunk_id").alias("query_id"), F.col("chunk_id").alias("corpus_id"), F.lit(1).cast("int").alias("score"), F.col("eval_split").alias("split"))


def vectors_view(embedded: DataFrame, inline: bool = False) -> DataFrame:
    """Keys and pointers of embedded rows, and the vectors where they are asked for beside the files."""
    return embedded.select("chunk_id", "language", "vector_shard", "row_in_shard", *(["embedding"] if inline else []))


def card(cfg: Config, counts: dict[str, int]) -> str:
    """The dataset card: front matter with one configuration per view, the schema, the counts and the settings."""
    views = "\n".join(f"- config_name: {v}\n  data_files: {v}/**/*.parquet" for v in ("corpus", "queries", "qrels", "vectors"))
    rows = "\n".join(f"| {n} | {k} | {'yes' if null else 'no'} | {note} |" for n, k, null, note in describe())
    figures = "\n".join(f"- {k}: {v:,}" for k, v in counts.items())
    return (
        f"---\npretty_name: {cfg.run.name}\nconfigs:\n{views}\n---\n\n# {cfg.run.name}\n\n{figures}\n\n"
        f"Texts are published only under these licences: {', '.join(cfg.corpus.license_allowlist)}; other texts are empty.\n\n"
        f"## Columns\n\n| name | type | may be null | meaning |\n|-|-|-|-|\n{rows}\n\n## Settings\n\n```json\n{json.dumps(cfg.to_dict(), indent=1, sort_keys=True)}\n```\n"
    )


def assemble(cfg: Config, chunks: DataFrame, embedded: DataFrame | None, gate: bool = True) -> dict[str, int]:
    """Writes the views of a run below publish/<view>/run=<name>, so several runs lie side by side, and the card.

    The vectors are written as the files that the pointers name; the index view holds the index tables and model.
    """
    spark = chunks.sparkSession
    views = {"corpus": corpus_view(chunks, gate), "queries": queries_view(chunks), "qrels": qrels_view(chunks).withColumn("language", F.lit("all"))}
    if embedded is not None:
        views["vectors"] = vectors_view(embedded, cfg.publish.emit_inline_embedding)
        made = npy.write_files(embedded.select(F.col("vector_shard").alias("file"), F.col("row_in_shard").alias("row"), F.col("embedding").alias("vector")), cfg.publish_dir, cfg.model.vector_dtype)
        files = {r.file: r.rows for r in made.collect()}  # a row for each shard
        if sum(files.values()) != embedded.count():
            raise RuntimeError("published vector files lack rows")
    counts = {}
    if fs.exists(spark, cfg.index_dir):
        counts["index_files"] = fs.copy(spark, cfg.index_dir, f"{cfg.publish_dir}/index/run={cfg.run.name}")
    for name, df in views.items():
        target = f"{cfg.publish_dir}/{name}/run={cfg.run.name}"
        write_partitioned(df, target, "language")
        counts[name] = chunks.sparkSession.read.schema(df.schema).parquet(target).count()
    fs.write_bytes(chunks.sparkSession, f"{cfg.publish_dir}/README.md", card(cfg, counts).encode())
    return counts


def publish(spark: SparkSession, cfg: Config, upload=None, dry_run: bool = True) -> dict[str, object]:
    """Counts the files and hands the folder to `upload(folder, repo_id)`; a dry run stops before that.

    Without an upload function a repo_id that is a path or URI is where the folder is copied to.
    """
    files = fs.count_files(spark, cfg.publish_dir)
    done = False
    if not dry_run:
        if upload is None and not re.match(r"[\w+.-]+:/|/", cfg.publish.repo_id):
            raise ValueError("an upload needs a function, or a path or URI as repo_id")
        if upload is None:
            fs.copy(spark, cfg.publish_dir, cfg.publish.repo_id)
        else:
            upload(cfg.publish_dir, cfg.publish.repo_id)
        done = True
    return {"files": files, "many_files": files > MANY_FILES, "uploaded": done}
