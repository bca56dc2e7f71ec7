"""Embedding engines as plug-ins, run over Arrow batches so that a model loads once per Python worker."""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
import urllib.request
from abc import ABC, abstractmethod
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.operators.sharding import folder_name
from chunkloom.schema import canonical


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows at unit length; rows of zeros stay."""
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1.0, n)


class Embedder(ABC):
    """An engine turns a list of texts into a matrix with a row per text."""

    def __init__(self, model_id: str, *, embed_dim: int, dtype: str = "float32", pooling: str = "last_token", normalize: bool = True, query_instruction: str = "", batch_size: int = 32):
        self.model_id, self.embed_dim, self.dtype, self.pooling = model_id, embed_dim, dtype, pooling
        self.normalize, self.query_instruction, self.batch_size = normalize, query_instruction, batch_size

    @abstractmethod
    def encode(self, texts: list[str], is_query: bool) -> np.ndarray:
        """Raw vectors, at least as wide as the engine gives them."""

    def embed_documents(self, texts: list[str]) -> np.ndarray:
        return self._finish(self.encode(texts, False), len(texts))

    def embed_queries(self, texts: list[str]) -> np.ndarray:
        wrapped = [f"Instruct: {self.query_instruction}\nQuery: {t}" for t in texts] if self.query_instruction else texts
        return self._finish(self.encode(wrapped, True), len(texts))

    def _finish(self, m: np.ndarray, rows: int) -> np.ndarray:
        """Cuts wider vectors to embed_dim and brings them to unit length again."""
        m = np.asarray(m, dtype=np.float32)
        if m.ndim != 2 or len(m) != rows:
            raise ValueError(f"the engine gave shape {m.shape} for {rows} texts")
        wide = m.shape[1] > self.embed_dim
        m = m[:, : self.embed_dim]
        return unit_rows(m).astype(np.float32) if self.normalize or wide else m

    def close(self) -> None:
        """Frees what the engine holds."""


class HashedTf(Embedder):
    """Counts of hashed words: deterministic, needs no model, and its inner products are exact integers."""

    WORD = re.compile(r"[a-z0-9_]+")

    def __init__(self, model_id: str = "hashed-tf", **options):
        options.setdefault("embed_dim", 256)
        super().__init__(model_id, **options)
        self._slot: dict[str, int] = {}

    def encode(self, texts: list[str], is_query: bool) -> np.ndarray:
        out = np.zeros((len(texts), self.embed_dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for w in self.WORD.findall(t.lower()):
                k = self._slot.get(w)
                if k is None:
                    if len(self._slot) > 500_000:
                        self._slot.clear()
                    k = self._slot[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % self.embed_dim
                out[i, k] += 1
        return out


class HttpEmbedder(Embedder):
    """A text-embedding service over HTTP: POST {inputs, normalize, truncate} to /embed of several replicas."""

    def __init__(self, model_id: str, *, endpoints: list[str] | None = None, base_port: int = 8080, replicas: int = 4, timeout: float = 120.0, **options):
        super().__init__(model_id, **options)
        listed = os.environ.get("CHUNKLOOM_ENDPOINTS", "")
        self.endpoints = endpoints or [e for e in listed.split(",") if e] or [f"http://127.0.0.1:{base_port + i}" for i in range(replicas)]
        self.timeout = timeout

    def _post(self, first: int, texts: list[str]) -> list[list[float]]:
        """Tries the replicas in turn, waiting longer after each failure."""
        body = json.dumps({"inputs": [t if t.strip() else " " for t in texts], "normalize": False, "truncate": True}).encode()
        # Attempts, and seconds to wait after each
        attempts = max(4, 2 * len(self.endpoints))
        for k in range(attempts):
            url = self.endpoints[(first + k) % len(self.endpoints)] + "/embed"
            try:
                request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
                with urllib.request.urlopen(request, timeout=self.timeout) as got:
                    return json.load(got)
            except OSError:
                if k == attempts - 1:
                    raise
                time.sleep(min(2**k, 8))
        raise AssertionError

    def encode(self, texts: list[str], is_query: bool) -> np.ndarray:
        parts = [texts[i : i + self.batch_size] for i in range(0, len(texts), self.batch_size)]
        with ThreadPoolExecutor(max(1, len(self.endpoints))) as pool:
            got = list(pool.map(self._post, range(len(parts)), parts))
        return np.array([v for part in got for v in part], dtype=np.float32).reshape(len(texts), -1)


class _Optional(Embedder):
    """An engine whose library is imported when it is first used."""

    def _model(self):
        if not hasattr(self, "_loaded"):
            self._loaded = self._load()
        return self._loaded

    def _load(self):
        raise NotImplementedError


class SentenceTransformer(_Optional):
    def _load(self):
        from sentence_transformers import SentenceTransformer as Model

        return Model(self.model_id)

    def encode(self, texts: list[str], is_query: bool) -> np.ndarray:
        return self._model().encode(texts, batch_size=self.batch_size, normalize_embeddings=False)


class VllmPooling(_Optional):
    def __init__(self, model_id: str, *, allow_fp8: bool = False, **options):
        super().__init__(model_id, **options)
        if self.dtype == "fp8" and not allow_fp8:
            raise ValueError("fp8 loses quality and must be allowed explicitly")

    def _load(self):
        from vllm import LLM

        return LLM(model=self.model_id, task="embed", dtype=self.dtype)

    def encode(self, texts: list[str], is_query: bool) -> np.ndarray:
        return np.array([o.outputs.embedding for o in self._model().embed(texts)])


class Infinity(_Optional):
    def _load(self):
        from infinity_emb import EngineArgs, SyncEngineArray

        return SyncEngineArray.from_args([EngineArgs(model_name_or_path=self.model_id, engine="torch")])

    def encode(self, texts: list[str], is_query: bool) -> np.ndarray:
        vectors, _ = self._model().embed(model=self.model_id, sentences=texts).result()
        return np.array(vectors)


ENGINES: dict[str, Callable[..., Embedder]] = {"hashed_tf": HashedTf, "tei": HttpEmbedder, "sentence_transformers": SentenceTransformer, "vllm": VllmPooling, "infinity": Infinity}


def build(name: str, model_id: str, **options) -> Embedder:
    """The engine of a name; an unknown one raises ValueError."""
    if name not in ENGINES:
        raise ValueError(f"unknown engine {name!r}; known: {', '.join(sorted(ENGINES))}")
    return ENGINES[name](model_id, **options)


def embed(df: DataFrame, make: Callable[[], Embedder], text_col: str = "text", out_col: str = "embedding", queries: bool = False, keep: list[str] | None = None, rows: int = 1024) -> DataFrame:
    """Adds the vectors of a text column, narrow columns only: the kept ones and the vector.

    Null texts count as one space.  The engine is made once per task and gets at most `rows` texts at a time.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text_col]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), f"`{out_col}` array<float>"])

    def run(batches):
        engine = make()
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, rows):
                    batch = whole.slice(at, rows)
                    texts = [t if t and t.strip() else " " for t in batch.column(len(keep)).to_pylist()]
                    m = engine.embed_queries(texts) if queries else engine.embed_documents(texts)
                    offsets = pa.array(np.arange(0, m.size + 1, m.shape[1] or 1, dtype=np.int32)) if m.size else pa.array([0] * (len(texts) + 1), pa.int32())
                    vectors = pa.ListArray.from_arrays(offsets, pa.array(m.ravel(), pa.float32()))
                    yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), vectors], [*keep, out_col])
        finally:
            engine.close()

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col)).mapInArrow(run, schema)


def attach_vectors(rows: DataFrame, vectors: DataFrame, key: str = "chunk_id", vector: str = "embedding") -> DataFrame:
    """Rows with their vectors, one to one: a row without a vector, a vector without a row and keys that repeat on
    either side raise an error when the result is computed.  Null keys are errors too."""
    told = rows.withColumn("_row", F.lit(1)).join(vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector")), F.col(key) == F.col("_key"), "full")
    n = F.count("*").over(Window.partitionBy(key))
    wrong = F.col("_row").isNull() | F.col("_vector").isNull() | (n != 1)
    checked = told.withColumn("_ok", F.when(wrong, F.raise_error(F.concat(F.lit("no vector or row of its own: "), F.coalesce(F.col(key), F.col("_key"), F.lit("null"))))).otherwise(F.lit(True)))
    return checked.where(F.coalesce("_ok", F.lit(True))).select(*[F.col(f"`{c}`") for c in rows.columns], F.col("_vector").alias(vector))


def with_pointers(df: DataFrame, *, run: str, model_id: str, revision: str, dim: int, pooling: str, normalized: bool, dtype: str, inline: bool = False) -> DataFrame:
    """Sets the eight embedding columns on rows with shard_id and row_in_shard; the pointer names the published file."""
    file = F.format_string("vectors/lang=%s/%s-part-%05d.npy", folder_name(F.col("language")), F.lit(run), F.col("shard_id"))
    out = df.withColumns(
        {"vector_shard": file, "row_in_shard": F.col("row_in_shard").cast("int"), "model_id": F.lit(model_id), "model_revision": F.lit(revision), "embed_dim": F.lit(dim), "pooling": F.lit(pooling), "normalized": F.lit(normalized), "dtype": F.lit(dtype)}
    )
    return canonical(out if inline else out.drop("embedding"))
