"""Problem 2: the most similar vectors of every vector, by one small-world graph per shard and a merge.

Routing: a bounded sample gives micro-centroids, which are grouped into shards of about SHARD_ROWS vectors.  A
vector lives in the shard of its nearest micro-centroid and also visits the shards of its PROBES nearest ones.
Each shard is one task: it builds the graph (chunkloom.llm.hnsw) over the vectors that live there, answers
these from the graph, and searches it for the visitors.  A shard that would hold more than MAX_SHARD vectors
is split by hash into parts that all of its vectors visit; so it is beyond MAX_CENTROIDS x MAX_SHARD vectors, where
the visits of a vector begin to grow with the table.  The answers are merged per vector.

Equal vectors are one node.  Only the k + 1 least chunk_ids of a group of equal vectors can be among anyone's
k most similar (equal similarity, smaller id first), so these stand for the group without any loss.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.llm import hnsw
from chunkloom.llm.common import checkpointed, spread

K, WIDTH = 5, 64
SHARD_ROWS, MAX_SHARD = 32_768, 65_536
#: Micro-centroids: one per so many vectors, at most so many, fitted on so many sampled vectors each.
PER_CENTROID, MAX_CENTROIDS, SAMPLE_PER_CENTROID = 48, 8_192, 8
PROBES, EF_VISIT, EF_HOME = 8, 40, 40


def usable(vectors: DataFrame, width: int = WIDTH) -> DataFrame:
    """(chunk_id, embedding, key) of the vectors of the given width that are not all zeros and hold no null."""
    e = F.col("embedding")
    ok = (F.size(e) == width) & F.exists(e, lambda x: x != 0) & ~F.exists(e, lambda x: x.isNull() | F.isnan(x))
    return vectors.select("chunk_id", "embedding").where(F.col("chunk_id").isNotNull() & ok).withColumn("key", F.xxhash64("embedding"))


def _unit(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 6, seed: int = 42) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[a : a + 4096] @ c.T).argmax(axis=1) for a in range(0, len(x), 4096)])
        total = np.zeros(c.shape)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        c[norm > 0] = (total[norm > 0] / norm[norm > 0, None]).astype(np.float32)
    return c


class Router:
    """Micro-centroids, the shard of each, and into how many parts a shard is split."""

    def __init__(self, sample: np.ndarray, rows: int, shard_rows: int = SHARD_ROWS, max_shard: int = MAX_SHARD):
        shards = min(MAX_CENTROIDS, max(1, math.ceil(rows / shard_rows)))
        if shards == 1 or len(sample) < 2 * shards:
            self.centroids, self.shard = np.zeros((1, sample.shape[1] if sample.ndim == 2 else WIDTH), np.float32), np.zeros(1, np.int32)
            self.parts = np.array([max(1, math.ceil(rows / max_shard))])
            return
        k = max(shards, min(MAX_CENTROIDS, rows // PER_CENTROID, len(sample) // 2))
        self.centroids = spherical_kmeans(sample, k)
        groups = spherical_kmeans(self.centroids, shards, 20)
        self.shard = (self.centroids @ groups.T).argmax(axis=1).astype(np.int32)
        home = self.shard[(sample @ self.centroids.T).argmax(axis=1)]
        share = np.bincount(home, minlength=shards) / len(home)
        self.parts = np.maximum(1, np.ceil(share * rows / max_shard).astype(int))

    def route(self, x: np.ndarray, keys: np.ndarray, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, task, lives there) for every shard part that a vector lives in or visits."""
        offset = np.concatenate(([0], np.cumsum(self.parts)))
        near = np.argpartition(-(x @ self.centroids.T), min(probes, len(self.centroids)) - 1, axis=1)[:, :probes] if len(self.centroids) > 1 else np.zeros((len(x), 1), np.int64)
        sims = np.take_along_axis(x @ self.centroids.T, near, axis=1)
        home = self.shard[np.take_along_axis(near, sims.argmax(axis=1)[:, None], axis=1)[:, 0]]
        own = offset[home] + (keys % self.parts[home])
        row = np.repeat(np.arange(len(x)), near.shape[1])
        pairs = np.unique(np.stack([row, self.shard[near].ravel()], axis=1), axis=0)
        repeat = self.parts[pairs[:, 1]]
        rows = np.repeat(pairs[:, 0], repeat)
        first = np.repeat(np.cumsum(repeat) - repeat, repeat)
        task = offset[np.repeat(pairs[:, 1], repeat)] + (np.arange(len(rows)) - first)
        return rows, task, task == own[rows]


def fit_router(vectors: DataFrame, rows: int, shard_rows: int = SHARD_ROWS) -> Router:
    """Fits on at most MAX_CENTROIDS x SAMPLE_PER_CENTROID vectors, chosen by a hash of the id; all are indexed."""
    if rows <= shard_rows:
        return Router(np.zeros((0, WIDTH), np.float32), rows, shard_rows)
    want = min(MAX_CENTROIDS, rows // PER_CENTROID) * SAMPLE_PER_CENTROID
    pick = vectors.where(F.pmod(F.xxhash64(F.lit(7), "chunk_id"), F.lit(1_000_000)) < int(min(1.0, want / rows) * 1_000_000) + 1)
    got = pick.select("chunk_id", "embedding").limit(2 * want).toArrow().sort_by("chunk_id")
    return Router(_unit(got.column("embedding"), WIDTH), rows, shard_rows)


ROUTED = "task int, home boolean, key bigint, vector binary"
ANSWER = "key bigint, found array<struct<d: float, n: bigint>>"


def _routed(vectors: DataFrame, router: Router) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(router)

    def run(batches):
        r = shared.value
        for batch in batches:
            keys, first = np.unique(batch.column(1).to_numpy(zero_copy_only=False), return_index=True)  # equal vectors of a batch once
            part = batch.column(0).take(pa.array(first))
            x = _unit(part, WIDTH)
            rows, task, home = r.route(x, keys)
            data = pa.Array.from_buffers(pa.binary(4 * WIDTH), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(task.astype(np.int32)), pa.array(home), pa.array(keys[rows]), data.take(pa.array(rows))], ["task", "home", "key", "vector"])

    return spread(vectors.select("embedding", "key")).mapInArrow(run, ROUTED)


def _answer(table: pa.Table, k: int = K) -> pa.Table:
    """One shard part: its graph, and the k + 1 nearest nodes for each vector that lives in it or visits."""
    keys = table.column("key").to_numpy()
    home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
    flat = table.column("vector").combine_chunks()
    x = np.frombuffer(b"".join(v.as_py() for v in flat), np.float32).reshape(-1, WIDTH)
    at = np.flatnonzero(home)
    own, first = np.unique(keys[at], return_index=True)
    graph = hnsw.Graph(x[at[first]])
    answers = [(own, *graph.refine(k + 1, max(EF_HOME, 3 * k)))]
    at = np.flatnonzero(~home)
    if len(at) and len(own):
        other, first = np.unique(keys[at], return_index=True)
        answers.append((other, *graph.search(x[at[first]], k + 1, max(EF_VISIT, 3 * k))))
    who, what, sim = [], [], []
    length = []
    for q, nodes, sims in answers:
        good = nodes >= 0
        length.append(good.sum(axis=1))
        who.append(q)
        what.append(own[nodes[good]])
        sim.append(-sims[good])
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.concatenate(length)))).astype(np.int32))
    values = pa.StructArray.from_arrays([pa.array(np.concatenate(sim).astype(np.float32)), pa.array(np.concatenate(what).astype(np.int64))], ["d", "n"])
    return pa.table({"key": pa.array(np.concatenate(who)), "found": pa.ListArray.from_arrays(offsets, values)})


def neighbour_classes(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(key, found): per distinct vector the k + 1 nearest other distinct vectors as (negative similarity, key)."""
    rows = vectors.count()
    router = fit_router(vectors, rows, shard_rows)
    answers = _routed(vectors, router).groupBy("task").applyInArrow(lambda t: _answer(t, k), ANSWER)
    best = F.slice(F.array_distinct(F.array_sort(F.flatten(F.collect_list("found")))), 1, k + 1)
    return answers.groupBy("key").agg(best.alias("found"))


def neighbours(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(chunk_id, neighbours): per chunk its k most similar others as (negative similarity, chunk_id), nearest first.

    Null, all-zero and narrower vectors, vectors with a null entry and rows without chunk_id take no part; repeated
    rows count once; of equal similarities the smaller chunk_id comes first.  A table of fewer than k + 1 chunks
    gives shorter lists.
    """
    base = usable(vectors)
    members = base.select("chunk_id", "key").groupBy("chunk_id").agg(F.min("key").alias("key"))
    members = checkpointed(members)
    least = members.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("chunk_id"))).where(F.col("r") <= k + 1)
    classes = least.groupBy("key").agg(F.sort_array(F.collect_list("chunk_id")).alias("ids"))
    found = neighbour_classes(base.select("chunk_id", "embedding", "key"), k, shard_rows)
    own = F.array(F.struct(F.lit(-1.0).cast("float").alias("d"), F.col("key").alias("n")))
    edges = found.select("key", F.explode(F.concat(own, "found")).alias("f")).select("key", F.col("f.d").alias("d"), F.col("f.n").alias("n"))
    entry = F.transform("ids", lambda i: F.struct(F.col("d").alias("d"), i.alias("id")))
    lists = edges.join(classes.withColumnRenamed("key", "n"), "n").select("key", entry.alias("e")).groupBy("key").agg(F.slice(F.array_sort(F.flatten(F.collect_list("e"))), 1, k + 1).alias("best"))
    others = F.slice(F.filter("best", lambda e: e["id"] != F.col("chunk_id")), 1, k)
    return members.join(lists, "key").select("chunk_id", others.alias("neighbours"))


def pairs(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(chunk_id_a, chunk_id_b), a < b, of which one is among the other's k most similar."""
    one = neighbours(vectors, k, shard_rows).select("chunk_id", F.explode("neighbours.id").alias("other"))
    return one.select(F.least("chunk_id", "other").alias("chunk_id_a"), F.greatest("chunk_id", "other").alias("chunk_id_b")).distinct()
