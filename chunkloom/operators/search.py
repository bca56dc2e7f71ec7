"""Exact and approximate nearest-vector search.

Exact: a block of queries travels to the tasks, each task keeps its k best per query by matrix products, and a
narrow merge takes the k best of all.  The corpus side is read once per block and never shuffled.
Approximate: inverted lists around k-means centroids, vectors as product-quantization codes behind an
orthogonal rotation; a search probes the nearest lists, scores codes by lookup, and re-ranks exactly.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.operators.sharding import reliable, sample

#: Numbers (queries x dimensions) that one block of queries may hold: 64 MB; scores that a task holds at a time: 128 MB.
BLOCK_NUMBERS, SCORES = 8_000_000, 16_000_000
#: Rows that are multiplied at a time, at most.
ROWS = 4096
#: Numbers of the training sample that the driver may hold (float64: 512 MB), and passes of k-means in the cluster.
DRIVER_NUMBERS, CLUSTER_ROUNDS = 64_000_000, 6
#: Vectors of a list that one task may search; longer lists are split.
LIST_ROWS = 200_000
DIGITS = 9


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def score_block(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Scores of which greater is nearer, rounded so that equal vectors tie whatever the order of summation."""
    if metric == "inner_product":
        s = q @ x.T
    elif metric == "cosine":  # from exact sums of squares
        s = (q @ x.T) / np.maximum(np.sqrt((q * q).sum(axis=1)[:, None] * (x * x).sum(axis=1)[None, :]), 1e-300)
    elif metric in ("l2", "euclidean"):
        s = -((q * q).sum(axis=1)[:, None] - 2 * q @ x.T + (x * x).sum(axis=1)[None, :])
    else:
        raise ValueError(f"unknown metric {metric!r}")
    return np.round(s, DIGITS)


def _blocks(queries: DataFrame, id_col: str, vector_col: str) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The queries in blocks of bounded size, one block in the driver at a time: tasks pack them, no row is a Python object."""

    def pack(batches):
        for batch in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["packed"])

    waiting: list[pa.Table] = []
    for r in queries.select(id_col, vector_col).mapInArrow(pack, "packed binary").toLocalIterator():
        waiting.append(pa.ipc.open_stream(r.packed).read_all())
        whole = pa.concat_tables(waiting)
        dim = len(whole.column(1)[0])
        most = max(1, BLOCK_NUMBERS // max(1, dim))
        while whole.num_rows >= most:
            yield _block(whole.slice(0, most), dim)
            whole = whole.slice(most)
        waiting = [whole] if whole.num_rows else []
    if waiting:
        whole = pa.concat_tables(waiting)
        yield _block(whole, len(whole.column(1)[0]))


def _block(t: pa.Table, dim: int) -> tuple[pa.Array, np.ndarray]:
    return t.column(0).combine_chunks(), _matrix(t.column(1).combine_chunks(), dim)


class Best:
    """The k best rows per query of what a task has seen, as numbers of its rows; equal scores by the rows' keys."""

    def __init__(self, queries: int, k: int):
        self.k, self.scores, self.rows = k, np.full((queries, 0), -np.inf), np.empty((queries, 0), dtype=np.int32)
        self.keys: list = []

    def ranks(self) -> np.ndarray:
        """The place of each row in the order of the keys."""
        order = sorted(range(len(self.keys)), key=self.keys.__getitem__)
        out = np.empty(len(order), dtype=np.int64)
        out[order] = np.arange(len(order))
        return out

    def add(self, keys: list, score, rows: int) -> None:
        """Adds rows by their keys; score(a, b) gives the scores of rows a to b for all queries."""
        first = len(self.keys)
        self.keys += keys
        ranks = None
        step = max(64, min(ROWS, SCORES // max(1, len(self.scores)) - self.k))
        for a in range(0, rows, step):
            new = score(a, min(a + step, rows))
            s = np.concatenate([self.scores, new], axis=1)
            at = np.concatenate([self.rows, np.broadcast_to(np.arange(first + a, first + a + new.shape[1], dtype=np.int32), new.shape)], axis=1)
            if s.shape[1] > self.k:
                take = np.argpartition(-s, self.k - 1, axis=1)[:, : self.k]
                worst = np.take_along_axis(s, take, axis=1).min(axis=1)
                tied = np.flatnonzero((s >= worst[:, None]).sum(axis=1) > self.k)
                if len(tied):
                    ranks = self.ranks() if ranks is None else ranks
                for i in tied:  # of the equal ones the least keys
                    among = np.flatnonzero(s[i] >= worst[i])
                    take[i] = among[np.lexsort((ranks[at[i, among]], -s[i, among]))[: self.k]]
                s, at = np.take_along_axis(s, take, axis=1), np.take_along_axis(at, take, axis=1)
            self.scores, self.rows = s, at


def exact_topk(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "inner_product", qid: str = "qid", cid: str = "cid", vector: str = "embedding") -> DataFrame:
    """(qid, cid, rank, score): the k best of the corpus per query, rank from 0; equal scores by smaller cid.

    Null vectors take no part.  Each query gets at most k rows per task, so the merge moves tasks x k rows.  A corpus
    that more than one block of queries reads is computed once and written (checkpoint).
    """
    spark = corpus.sparkSession
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0)
    qt, ct = queries.schema[qid].dataType.simpleString(), corpus.schema[cid].dataType.simpleString()
    corpus = corpus.where(usable).select(cid, vector)
    out, blocks = None, _blocks(queries.where(usable), qid, vector)
    at_hand = next(blocks, None)
    while at_hand is not None:
        ids, q = at_hand
        at_hand = next(blocks, None)
        if at_hand is not None and out is None:
            corpus = reliable(corpus)
        shared = spark.sparkContext.broadcast((ids, q))

        def run(batches, shared=shared):
            ids, q = shared.value
            best, kind = Best(len(q), k), None
            for batch in batches:
                kind = batch.schema.field(0).type
                x = _matrix(batch.column(1), q.shape[1])
                best.add(batch.column(0).to_pylist(), lambda a, b, x=x: score_block(q, x[a:b], metric), len(x))
            n = best.scores.shape[1]
            if n:
                keys = pa.array(best.keys, kind).take(pa.array(best.rows.ravel()))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(len(q)), n))), keys, pa.array(best.scores.ravel())], [qid, cid, "score"])

        part = corpus.mapInArrow(run, f"`{qid}` {qt}, `{cid}` {ct}, score double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"`{qid}` {qt}, `{cid}` {ct}, rank int, score double")
    return _merged(out, k, qid, cid)


def _merged(found: DataFrame, k: int, qid: str, cid: str) -> DataFrame:
    """The k best of each query's rows from many tasks."""
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("d"), F.col(cid).alias("c")))), 1, k)
    return found.groupBy(qid).agg(best.alias("b")).select(qid, F.posexplode("b").alias("rank", "e")).select(qid, F.col("e.c").alias(cid), F.col("rank").cast("int"), (-F.col("e.d")).alias("score"))


_FACTORY = re.compile(r"^(?:OPQ(?P<opq>\d+)(?:_(?P<width>\d+))?,)?(?:IVF(?P<lists>\d+)(?:_HNSW\d+)?,)?(?:PQ(?P<pq>\d+)(?:x(?P<bits>\d+))?|(?P<flat>Flat))$", re.I)


def parse_factory(text: str) -> dict[str, int | bool]:
    """An index description such as Flat, IVF64,Flat or OPQ8_32,IVF64_HNSW32,PQ8; others raise ValueError."""
    m = _FACTORY.match(text.strip())
    if not m:
        raise ValueError(f"unsupported index {text!r}")
    g = m.groupdict()
    return {"rotate": bool(g["opq"]), "width": int(g["width"] or 0), "lists": int(g["lists"] or 0), "parts": int(g["pq"] or 0), "bits": int(g["bits"] or 8), "flat": bool(g["flat"])}


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 42) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([((c * c).sum(1)[None] - 2 * x[a : a + ROWS] @ c.T).argmin(1) for a in range(0, len(x), ROWS)])
        total, n = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


@dataclass(frozen=True)
class VectorIndex:
    """What search needs besides the table of lists: rotation, centroids, codebooks, and into how many parts a list is split."""

    rotation: np.ndarray
    centroids: np.ndarray
    codebooks: np.ndarray | None  # [parts, codes, width]
    splits: np.ndarray | None = None

    def lists_of(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each rotated vector, the nearest first; distances of a bounded number of rows at a time."""
        n = min(n, len(self.centroids))
        norms, out = (self.centroids**2).sum(1)[None], []
        step = max(1, SCORES // len(self.centroids))
        for a in range(0, len(x), step):
            d = norms - 2 * x[a : a + step] @ self.centroids.T
            if n == 1:
                out.append(d.argmin(axis=1)[:, None])
                continue
            near = np.argpartition(d, n - 1, axis=1)[:, :n]
            out.append(np.take_along_axis(near, np.take_along_axis(d, near, axis=1).argsort(axis=1, kind="stable"), axis=1))
        return np.concatenate(out) if out else np.zeros((0, n), np.int64)

    def parts_of(self, lists: np.ndarray) -> np.ndarray:
        return self.splits[lists] if self.splits is not None else np.ones(lists.shape, np.int64)

    def encode(self, x: np.ndarray) -> np.ndarray:
        m, _, w = self.codebooks.shape
        return np.stack([((self.codebooks[j] ** 2).sum(1)[None] - 2 * x[:, j * w : (j + 1) * w] @ self.codebooks[j].T).argmin(1) for j in range(m)], axis=1).astype(np.uint8)


def cluster_kmeans(vectors: DataFrame, base: np.ndarray, start: np.ndarray, rounds: int = CLUSTER_ROUNDS, vector: str = "embedding") -> np.ndarray:
    """k-means over vectors that stay in the cluster: tasks pass on the sums of their nearest centroids, one row each, which
    are added up by centroid.  The driver holds the centroids only.  One that is nearest to none keeps its place."""
    centroids = start.copy()
    for _ in range(rounds):
        shared = vectors.sparkSession.sparkContext.broadcast(VectorIndex(base, centroids, None))

        def run(batches, shared=shared):
            ix = shared.value
            total: dict[int, np.ndarray] = {}
            count: dict[int, int] = {}
            for batch in batches:
                y = _matrix(batch.column(0), len(ix.rotation)) @ ix.rotation
                near = ix.lists_of(y, 1)[:, 0]
                order = np.argsort(near, kind="stable")
                edge = np.flatnonzero(np.concatenate(([True], near[order][1:] != near[order][:-1]))) if len(near) else []
                for c, part, n in zip(near[order][edge].tolist(), np.add.reduceat(y[order], edge) if len(edge) else [], np.diff(np.append(edge, len(near)))):
                    total[c] = total[c] + part if c in total else part
                    count[c] = count.get(c, 0) + int(n)
            for c, v in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([count[c]], pa.int64()), pa.array([v.tolist()], pa.list_(pa.float64()))], ["c", "n", "v"])

        def add(t: pa.Table) -> pa.Table:
            v = np.stack([np.array(x.as_py()) for x in t.column("v")]).sum(axis=0)
            return pa.table({"c": t.column("c").slice(0, 1), "n": pa.array([sum(t.column("n").to_pylist())], pa.int64()), "v": pa.array([v.tolist()], pa.list_(pa.float64()))})

        schema = "c int, n bigint, v array<double>"
        sums = vectors.select(vector).mapInArrow(run, schema).groupBy("c").applyInArrow(add, schema)
        moved = centroids.copy()
        for r in sums.toLocalIterator():
            moved[r.c] = np.array(r.v) / r.n
        centroids = moved
    return centroids


def train_index(vectors: DataFrame, lists: int, parts: int = 0, codes: int = 256, rotate: bool = False, train_sample: int = 100_000, seed: int = 42, key: str = "cid", vector: str = "embedding", width: int = 0, driver_numbers: int = DRIVER_NUMBERS, list_rows: int = LIST_ROWS) -> VectorIndex:
    """Trains on train_sample rows by seeded hash, of which at most driver_numbers numbers reach the driver.

    Rotation and codebooks come from what the driver holds; so do the centroids where that is the whole sample, else
    they are moved in the cluster over all of it, beginning at sampled vectors.  A width under the vectors' own keeps that
    many principal directions.  The rotation is learnt by alternating between codebooks and the orthogonal map that
    fits them best.  Lists that by the sample would hold more than list_rows vectors are split.
    """
    usable = vectors.where(F.col(vector).isNotNull()).select(key, vector)
    head = usable.select(vector).first()
    if head is None:
        raise ValueError("no vectors to train on")
    dim = len(head[0])
    held = max(lists if width == 0 or width >= dim else 1, min(train_sample, driver_numbers // dim))
    got = sample(usable, held, key, seed).toArrow()
    x = _matrix(got.column(vector).combine_chunks(), dim)
    base = np.eye(dim)
    if 0 < width < dim:
        base = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :width]
        x, dim = x @ base, width
    rotation = np.eye(dim)

    def books(y: np.ndarray, rounds: int) -> np.ndarray:
        w = dim // parts
        return np.stack([np.pad(c := kmeans(y[:, j * w : (j + 1) * w], codes, rounds, seed + j), ((0, codes - len(c)), (0, 0)), constant_values=1e6) for j in range(parts)])

    if parts:
        if dim % parts:
            raise ValueError("the dimensions must be a multiple of the parts")
        if rotate:
            for _ in range(4):
                y = x @ rotation
                b = VectorIndex(rotation, np.zeros((1, dim)), books(y, 4))
                codes_ = b.encode(y)
                back = np.concatenate([b.codebooks[j][codes_[:, j]] for j in range(parts)], axis=1)
                u, _, v = np.linalg.svd(x.T @ back)
                rotation = u @ v
    y = x @ rotation
    if held >= train_sample or len(y) < held:
        centroids = kmeans(y, lists, seed=seed)
    else:
        some = reliable(sample(usable, train_sample, key, seed))
        start = kmeans(y, lists, rounds=0, seed=seed) if len(y) >= lists else _matrix(sample(some, lists, key, seed + 1).toArrow().column(vector).combine_chunks(), len(base)) @ base @ rotation
        centroids = cluster_kmeans(some, base @ rotation, start, vector=vector)
    ix = VectorIndex(base @ rotation, centroids, books(y, 12) if parts else None)
    share = np.bincount(ix.lists_of(y, 1)[:, 0], minlength=len(centroids)) / len(y)
    return VectorIndex(ix.rotation, ix.centroids, ix.codebooks, np.maximum(1, np.ceil(share * usable.count() / list_rows)).astype(np.int64))


def lists_for(rows: int) -> int:
    """The number of lists for a table: a third of the root of its rows, so that a list grows no faster than three roots; 16 at least."""
    return max(16, math.isqrt(max(rows, 0)) // 3)


def add_to_index(vectors: DataFrame, index: VectorIndex, key: str = "cid", vector: str = "embedding") -> DataFrame:
    """The index table: (list_id, part, key, code, vector) of every vector; code is null without codebooks."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches):
        ix = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), len(ix.rotation)) @ ix.rotation
            code = pa.array([bytes(c) for c in ix.encode(x)], pa.binary()) if ix.codebooks is not None else pa.nulls(len(x), pa.binary())
            lists = ix.lists_of(x, 1)[:, 0]
            part = np.arange(len(x)) % ix.parts_of(lists)
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), pa.array(part.astype(np.int32)), batch.column(0), code, batch.column(1)], ["list_id", "part", key, "code", vector])

    return vectors.where(F.col(vector).isNotNull()).select(key, vector).mapInArrow(run, f"list_id int, part int, `{key}` {kind}, code binary, `{vector}` array<float>")


def search_index(queries: DataFrame, table: DataFrame, index: VectorIndex, k: int, nprobe: int = 32, rerank: int = 4, qid: str = "qid", cid: str = "cid", vector: str = "embedding", rerank_share: float = 0.0, metric: str = "inner_product") -> DataFrame:
    """(qid, cid, rank, score) by probing lists: the task of a list's part scores its codes for the queries that probe it,
    keeps rerank x k of them by code, or rerank_share of the part where that is more, re-ranks these exactly by the
    metric (inner_product or l2), and the best k per query are merged."""
    if metric not in ("inner_product", "l2", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    far = metric != "inner_product"
    shared = table.sparkSession.sparkContext.broadcast(index)
    qt, ct = queries.schema[qid].dataType.simpleString(), table.schema[cid].dataType.simpleString()

    def probe(batches):
        ix = shared.value
        for batch in batches:
            near = ix.lists_of(_matrix(batch.column(1), len(ix.rotation)) @ ix.rotation, nprobe)
            parts = ix.parts_of(near.ravel())
            rows = pa.array(np.repeat(np.repeat(np.arange(len(near)), near.shape[1]), parts))
            part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(near.ravel(), parts).astype(np.int32)), pa.array(part.astype(np.int32)), batch.column(0).take(rows), batch.column(1).take(rows)], ["list_id", "part", qid, vector])

    probes = queries.where(F.col(vector).isNotNull()).select(qid, vector).mapInArrow(probe, f"list_id int, part int, `{qid}` {qt}, `{vector}` array<float>")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ix = shared.value
        who, what, scores = [], [], []
        if left.num_rows and right.num_rows:
            x = _matrix(right.column(vector).combine_chunks(), len(ix.rotation))
            codes = np.frombuffer(b"".join(right.column("code").to_pylist()), np.uint8).reshape(len(x), -1) if ix.codebooks is not None else None
            every = _matrix(left.column(vector).combine_chunks(), len(ix.rotation))
            n = min(len(x), max(k * max(1, rerank), math.ceil(rerank_share * len(x))))
            norms = (x * x).sum(axis=1) if far else None
            step = max(1, BLOCK_NUMBERS // len(x))
            for a in range(0, len(every), step):  # scores of a block of queries at a time
                q = every[a : a + step]
                if codes is not None:
                    m, _, w = ix.codebooks.shape
                    y = q @ ix.rotation
                    less = [0.5 * (b * b).sum(axis=1) if far else 0.0 for b in ix.codebooks]
                    rough = sum(((y[:, j * w : (j + 1) * w] @ ix.codebooks[j].T - less[j])[:, codes[:, j]] for j in range(m)), np.zeros((len(q), len(x))))
                else:
                    rough = q @ x.T - (0.5 * norms if far else 0.0)
                top = np.argpartition(-rough, n - 1, axis=1)[:, :n] if n < len(x) else np.tile(np.arange(len(x)), (len(q), 1))
                for i, at in enumerate(top):
                    s = np.round(x[at] @ q[i] if not far else -(q[i] @ q[i] - 2 * (x[at] @ q[i]) + norms[at]), DIGITS)
                    best = np.argsort(-s, kind="stable")[:k]
                    who.append(np.full(len(best), a + i))
                    what.append(at[best])
                    scores.append(s[best])
        who, what = (pa.array(np.concatenate(z) if z else np.zeros(0, np.int64)) for z in (who, what))
        return pa.table({qid: left.column(qid).take(who), cid: right.column(cid).take(what), "score": pa.array(np.concatenate(scores) if scores else np.zeros(0))})

    found = probes.groupBy("list_id", "part").cogroup(table.groupBy("list_id", "part")).applyInArrow(score, f"`{qid}` {qt}, `{cid}` {ct}, score double")
    return _merged(found, k, qid, cid)
