"""The stages of a run: stage, chunk, shard, embed, index, merge, publish, evaluate.  They hand over by files only."""

from __future__ import annotations

import io
import json
import logging
import re
from collections.abc import Callable
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.config import Config
from chunkloom.functions import keys
from chunkloom.functions.docs import extract_docstring
from chunkloom.functions.text import assign_query, keep_existing_query
from chunkloom.operators import embedding, search, sharding
from chunkloom.operators.chunking import chunk_files
from chunkloom.plans import evaluate as E
from chunkloom.plans import publish as P
from chunkloom.schema import CHUNK_COLUMNS, canonical
from chunkloom.sources import files, fs, npy
from chunkloom.streaming.ingest import embed_stream, read_sink, read_stream

log = logging.getLogger("chunkloom")


def stage(spark: SparkSession, cfg: Config, raw: DataFrame | None, eval_sources: dict[str, str] | None = None, skip_corpus: bool = False, skip_model: bool = True) -> None:
    """Writes the corpus, the evaluation pack and the model of a run; what is staged is left."""
    if not skip_corpus and raw is not None:
        files.stage_corpus(raw, cfg.corpus_dir, cfg.corpus.languages, cfg.corpus.max_files_per_lang)
    if eval_sources:
        files.stage_eval_pack(spark, eval_sources, cfg.under("eval-pack"))
    if not skip_model:
        stage_model(spark, cfg)


def staged_model(spark: SparkSession, cfg: Config) -> str:
    """Where the model lies: its staged folder if there is one, else its name for the engine to resolve."""
    folder = f"{cfg.models_dir}/staged/{cfg.model.id.strip('/').replace('/', '--')}"
    return folder if files.is_staged(spark, folder) else cfg.model.id


def stage_model(spark: SparkSession, cfg: Config) -> str:
    """Copies a model's folder to the run's models; FileNotFoundError where its name is no folder that can be reached."""
    folder = f"{cfg.models_dir}/staged/{cfg.model.id.strip('/').replace('/', '--')}"
    if not files.is_staged(spark, folder):
        if not fs.exists(spark, cfg.model.id):
            raise FileNotFoundError(f"the model {cfg.model.id} is no folder; models can't be fetched from elsewhere")
        fs.copy(spark, cfg.model.id, folder)
        files.mark_staged(spark, folder, {"model": cfg.model.id, "revision": cfg.model.revision})
    return folder


def chunk(spark: SparkSession, cfg: Config, languages: list[str] | None = None, source: str | None = None, out: str | None = None) -> None:
    """Chunks staged files; parts without chunks leave no file."""
    rows = files.read_corpus(spark, source or cfg.corpus_dir, languages)
    c = cfg.chunk
    made = chunk_files(rows, cfg.corpus.license_allowlist, f"{cfg.corpus.dataset_id}@{cfg.corpus.revision}", c.max_tokens, c.overlap_tokens, c.min_tokens, c.unit, tokenizer=c.tokenizer)
    files.write_partitioned(made, out or cfg.chunks_dir, "language")


def attach_docs(chunks: DataFrame, docs: DataFrame | None, name: str, on: str = "chunk_id") -> DataFrame:
    """Adds a text from elsewhere (on, doc) to the chunks, null where there is none; of several the least."""
    if docs is None:
        return chunks.withColumn(name, F.lit(None).cast("string"))
    one = docs.where(F.col(on).isNotNull()).groupBy(on).agg(F.min("doc").alias(name))
    return chunks.join(one, on, "left")


def assign_pairs(chunks: DataFrame, listed: DataFrame, seed: int, hash_fn: str = "blake2b", joined: DataFrame | None = None, commits: DataFrame | None = None) -> DataFrame:
    """Sets query_text, query_source and eval_split.

    `joined` and `commits` (chunk_id, doc) hold documentation and commit subjects from elsewhere.  `listed` holds evaluation repositories (repo_name); it is a list that people keep, so it is a small join side.
    """
    columns = chunks.columns
    chunks = attach_docs(attach_docs(chunks, joined, "_joined"), commits, "_commit")
    q = keep_existing_query(F.col("query_text"), assign_query(F.col("_joined"), extract_docstring("text", "language"), F.col("_commit")))
    empty = F.lit(listed.isEmpty())
    flag = listed.select("repo_name").distinct().withColumn("_listed", F.lit(True))
    slot = keys.bucket(F.col("repo_name"), seed, hash_fn=hash_fn)
    joined = chunks.join(F.broadcast(flag), "repo_name", "left") if listed.count() < 1_000_000 else chunks.join(flag, "repo_name", "left")
    out = joined.withColumn("_q", q).withColumns({"query_text": F.col("_q.query_text"), "query_source": F.col("_q.query_source"), "eval_split": keys.eval_split(slot, F.coalesce("_listed", F.lit(False)), empty)})
    return out.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, "query_text", "query_source", "eval_split"])])


def shard(spark: SparkSession, cfg: Config, target: int | None = None, pairs: bool = True, eval_list: str | None = None, hash_fn: str = "blake2b", languages: list[str] | None = None) -> DataFrame:
    """Deduplicates, numbers and writes the shards of all (or some) languages and their manifest; returns the manifest.

    Each shard is a Parquet folder under the very name that the manifest gives.
    """
    rows = files.read_chunks(spark, cfg.chunks_dir, languages)
    once = sharding.keep_first(rows, ["language", "chunk_id"], ["path", "start_line"])
    assigned = sharding.assign_shards(once, target or cfg.shard.target_chunks, cfg.corpus.languages)
    if pairs:
        listed = files.read_names(spark, eval_list) if eval_list else spark.createDataFrame([], "repo_name string")
        assigned = assign_pairs(assigned, listed, cfg.run.seed, hash_fn)
    files.write_partitioned(assigned.withColumn("_folder", sharding.folder_name(F.col("language"))), f"{cfg.shards_dir}.new", "_folder", "shard_id")
    fs.delete(spark, cfg.shards_dir)
    for p in fs.glob(spark, f"{cfg.shards_dir}.new/__folder=*/_shard_id=*"):  # a folder for each shard
        language, number = re.search(r"__folder=([^/]*)/_shard_id=(\d+)$", p).groups()
        fs.rename(spark, p, f"{cfg.shards_dir}/lang={language}/shard-{int(number):05d}.parquet")
    fs.delete(spark, f"{cfg.shards_dir}.new")
    shards = sharding.manifest(read_shards(spark, cfg), cfg.under("") + "/")
    files.write_manifest(shards, cfg.manifest_path)
    fs.delete(spark, cfg.status_dir)
    return files.read_manifest(spark, cfg.manifest_path)


def read_shards(spark: SparkSession, cfg: Config) -> DataFrame:
    """The rows of all shards."""
    if not fs.glob(spark, f"{cfg.shards_dir}/lang=*/shard-*.parquet"):
        raise files.MissingInput(cfg.shards_dir)
    return spark.read.parquet(f"{cfg.shards_dir}/lang=*/shard-*.parquet").drop("_folder")


STATUS = "shard_id int, status string, language string, row_total int, logged_at timestamp, received_at timestamp"


def log_status(spark: SparkSession, cfg: Config, shards: DataFrame, status: str) -> None:
    """Appends a status for each of some shards of the manifest."""
    if status not in ("pending", "running", "done"):
        raise ValueError(f"status {status!r}")
    now = F.current_timestamp()
    rows = shards.select("shard_id", F.lit(status).alias("status"), "language", F.col("approx_chunks").alias("row_total"), now.alias("logged_at"), now.alias("received_at"))
    rows.coalesce(1).write.mode("append").json(cfg.status_dir)


def status_log(spark: SparkSession, cfg: Config) -> DataFrame:
    """All status entries; none where nothing was logged."""
    return spark.read.schema(STATUS).json(cfg.status_dir) if fs.exists(spark, cfg.status_dir) else spark.createDataFrame([], STATUS)


def engine(cfg: Config, base_port: int | None = None, model: str | None = None) -> Callable[[], embedding.Embedder]:
    """What makes the configured engine within a task."""
    m = cfg.model
    options = {"embed_dim": m.embed_dim, "dtype": m.dtype, "pooling": m.pooling, "normalize": m.normalize, "query_instruction": m.query_instruction, "batch_size": cfg.engine.batch_size}
    if cfg.engine.name == "tei":
        options["replicas"] = cfg.engine.replicas_per_gpu
        if base_port is not None:
            options["base_port"] = base_port
    return partial(embedding.build, cfg.engine.name, model or m.id, **options)


def embed(spark: SparkSession, cfg: Config, resume: bool = True, shard_id: int | None = None, base_port: int | None = None) -> int:
    """Embeds the rows of the shards that are not done, checks the row counts, writes the shards' vector files and the
    embedded rows, and logs the shards as done; returns the rows in the sink."""
    everything = files.read_manifest(spark, cfg.manifest_path)
    shards = files.get_shard(everything, shard_id) if shard_id is not None else everything
    if not resume and shard_id is not None:
        raise ValueError("beginning anew is for all shards")
    todo = sharding.reliable(sharding.pending_shards(shards, status_log(spark, cfg)) if resume else shards)
    if not todo.isEmpty():
        log_status(spark, cfg, todo, "running")
        schema = read_shards(spark, cfg).schema
        stream = read_stream(spark, cfg.shards_dir, schema).join(F.broadcast(todo.select("shard_id")) if todo.count() < 1_000_000 else todo.select("shard_id"), "shard_id", "left_semi")
        make = engine(cfg, base_port, staged_model(spark, cfg))

        def run(batch: DataFrame) -> DataFrame:
            return embedding.embed(batch, make, "text", keep=["chunk_id", "language", "shard_id", "row_in_shard"], rows=min(1024, max(1, cfg.embed.checkpoint_every)))

        name = "embed" if shard_id is None else f"embed-{shard_id:05d}"
        embed_stream(stream, run, cfg.batches_dir, cfg.under("checkpoints", name), resume)
        got = read_sink(spark, cfg.batches_dir).join(todo.select("shard_id"), "shard_id", "left_semi")
        if bad := sharding.reconcile(got, todo).limit(5).collect():
            raise RuntimeError(f"shards with missing or surplus vectors: {bad}")
        write_vectors(spark, cfg, got, todo)
        log_status(spark, cfg, todo, "done")
    return read_sink(spark, cfg.batches_dir).count() if fs.glob(spark, f"{cfg.batches_dir}/batch=*") else 0


def write_vectors(spark: SparkSession, cfg: Config, vectors: DataFrame, shards: DataFrame) -> None:
    """Writes the vectors of some shards to the files that the manifest names, and their rows with pointers to embedded/."""
    root = cfg.under("")
    named = vectors.join(shards.select("shard_id", F.expr(f"substring(out_npy, {len(root) + 2})").alias("file")), "shard_id")
    made = npy.write_files(named.select("file", F.col("row_in_shard").alias("row"), F.col("embedding").alias("vector")), root, cfg.model.vector_dtype)
    if made.agg(F.sum("rows")).first()[0] != vectors.count():
        raise RuntimeError("vector files lack rows")
    rows = read_shards(spark, cfg).join(shards.select("shard_id"), "shard_id", "left_semi")
    m = cfg.model
    told = embedding.with_pointers(embedding.attach_vectors(rows, vectors.select("chunk_id", "embedding")), run=cfg.run.name, model_id=m.id, revision=m.revision, dim=m.embed_dim, pooling=m.pooling, normalized=m.normalize, dtype=m.dtype, inline=True)
    files.write_partitioned(told, cfg.embedded_dir, "language", mode="append")


def embedded(spark: SparkSession, cfg: Config) -> DataFrame:
    """The embedded rows with their pointers, one for each chunk."""
    if not fs.exists(spark, cfg.embedded_dir):
        raise files.MissingInput(cfg.embedded_dir)
    rows = canonical(spark.read.parquet(cfg.embedded_dir))
    return sharding.keep_first(rows, ["chunk_id"], ["vector_shard", "row_in_shard"])


def stored_vectors(spark: SparkSession, cfg: Config, shard_id: int | None = None) -> DataFrame:
    """(cid, embedding) of what is embedded; of one shard, checked against the manifest."""
    rows = read_sink(spark, cfg.batches_dir)
    if shard_id is not None:
        one = files.get_shard(files.read_manifest(spark, cfg.manifest_path), shard_id)
        rows = rows.where(F.col("shard_id") == shard_id)
        if bad := sharding.reconcile(rows, one).collect():
            raise RuntimeError(f"vectors and rows differ: {bad}")
    return rows.select(F.col("chunk_id").alias("cid"), "embedding")


def index(spark: SparkSession, cfg: Config, factory: str | None = None, shard_id: int | None = None) -> str:
    """Builds the index tables below index/; Flat needs none, for the vectors are the index.

    Of one shard only Flat can be built: lists over a part would have centroids of their own.
    """
    kind = search.parse_factory(factory or cfg.index.factory_smoke)
    if shard_id is not None and kind["lists"]:
        raise ValueError("an index with lists is built over all shards")
    vectors = stored_vectors(spark, cfg, shard_id)
    widths = vectors.agg(F.count_if(F.size("embedding") != cfg.model.embed_dim)).first()[0]
    if widths:
        raise ValueError(f"{widths} vectors are not of {cfg.model.embed_dim} numbers")
    if not kind["lists"]:
        return cfg.batches_dir
    ix = search.train_index(vectors, int(kind["lists"]), int(kind["parts"]), 2 ** int(kind["bits"]), bool(kind["rotate"]), cfg.index.train_sample, cfg.run.seed, width=int(kind["width"]))
    search.add_to_index(vectors, ix).write.mode("overwrite").partitionBy("list_id").parquet(f"{cfg.index_dir}/lists")
    books = {} if ix.codebooks is None else {"codebooks": ix.codebooks}
    model = io.BytesIO()
    np.savez(model, rotation=ix.rotation, centroids=ix.centroids, splits=ix.splits, **books)
    fs.write_bytes(spark, f"{cfg.index_dir}/model.npz", model.getvalue())
    return cfg.index_dir


def load_index(spark: SparkSession, cfg: Config) -> tuple[DataFrame, search.VectorIndex]:
    """The index tables and model; FileNotFoundError where none was built."""
    got = np.load(io.BytesIO(fs.read_bytes(spark, f"{cfg.index_dir}/model.npz")))
    return spark.read.parquet(f"{cfg.index_dir}/lists"), search.VectorIndex(got["rotation"], got["centroids"], got["codebooks"] if "codebooks" in got else None, got["splits"] if "splits" in got else None)


def merge_index(spark: SparkSession, cfg: Config, mode: str = "ondisk") -> str:
    """ondisk: one index over all shards; sharded: a list of the parts that a search gathers from."""
    if mode == "ondisk":
        return index(spark, cfg, cfg.index.factory_full)
    if mode != "sharded":
        raise ValueError(f"mode {mode!r}")
    parts = [p.rsplit(f"/{cfg.run.name}/", 1)[-1] for p in fs.glob(spark, f"{cfg.vectors_dir}/lang=*/shard-*.npy")]
    if not parts:
        raise FileNotFoundError(cfg.vectors_dir)
    fs.write_bytes(spark, f"{cfg.index_dir}/sharded.json", json.dumps({"parts": parts}).encode())
    return cfg.index_dir


def publish(spark: SparkSession, cfg: Config, dry_run: bool = True, upload=None) -> dict[str, object]:
    """Writes the views and the card, and uploads them unless it is a dry run."""
    rows = canonical(read_shards(spark, cfg), CHUNK_COLUMNS)
    counts = P.assemble(cfg, rows, embedded(spark, cfg) if fs.exists(spark, cfg.embedded_dir) else None)
    return {**counts, **P.publish(spark, cfg, upload, dry_run)}


def evaluate(spark: SparkSession, cfg: Config, split: str = "test", mode: str = "exact", base_port: int | None = None) -> dict:
    """Metrics of a split, exactly over stripped bodies and by the index over the stored vectors; written as JSON.

    Without index tables the stored vectors are searched themselves: they are the Flat index.  Where there are none, or
    the index fails, only its part of the report is null.
    """
    rows = canonical(read_shards(spark, cfg), CHUNK_COLUMNS)
    make, ks = engine(cfg, base_port, staged_model(spark, cfg)), list(cfg.eval.ks)
    k = max(*ks, 10)
    queries = E.eval_queries(rows, split)
    if queries.isEmpty():
        raise ValueError(f"no queries in {E.split_key(split)}")
    q = sharding.reliable(embedding.embed(queries, make, "query_text", out_col="embedding", keep=["qid"], queries=True))
    got: dict[str, dict | None] = {"exact": None, "ann": None}
    metric = "inner_product" if cfg.index.metric == "inner_product" else "l2"

    def scored(found: DataFrame) -> dict:
        return E.metrics(E.ranks_of_relevant(queries, found), ks).first().asDict()

    if mode in ("exact", "both"):
        got["exact"] = scored(search.exact_topk(q, embedding.embed(E.eval_corpus(rows), make, "text", keep=["cid"]), k, metric))
    if mode in ("ann", "both"):
        try:
            try:
                table, ix = load_index(spark, cfg)
                found = search.search_index(q, table, ix, k, cfg.index.nprobe, metric=metric)
            except FileNotFoundError:
                found = search.exact_topk(q, stored_vectors(spark, cfg), k, metric)
            got["ann"] = scored(found)
        except Exception as e:  # the exact figures must not be lost with it
            log.warning("the index can't be searched: %s", e)
    out = {
        "run": cfg.run.name, "eval_kind": "chunk-retrieval", "benchmark": cfg.eval.benchmark, "is_mteb_coir": False, "exact_corpus": "stripped bodies", "ann_corpus": "stored vectors",
        "split": E.split_key(split), "model_id": cfg.model.id, "model_revision": cfg.model.revision, "embed_dim": cfg.model.embed_dim, "dtype": cfg.model.dtype,
        "n_corpus": rows.count(), "n_queries": queries.count(), "ks": ks, "metrics": got,
    }
    fs.write_bytes(spark, f"{cfg.eval_dir}/report_{E.split_key(split)}.json", json.dumps(out, indent=1).encode())
    return out


def run_batches(spark: SparkSession, base: Config, batches: list[tuple[str, list[str]]], raw: DataFrame, done: set[str] | None = None) -> list[str]:
    """Runs all stages for a list of (run name, languages); finished runs are skipped."""
    import copy

    finished = []
    for name, languages in batches:
        if done and name in done:
            continue
        cfg = copy.deepcopy(base)
        cfg.run.name = name
        cfg.corpus.languages = languages or base.corpus.languages
        stage(spark, cfg, raw)
        chunk(spark, cfg)
        shard(spark, cfg)
        embed(spark, cfg)
        index(spark, cfg)
        publish(spark, cfg)
        finished.append(name)
    return finished
