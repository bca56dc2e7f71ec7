"""Retrieval evaluation: queries of a split against the whole corpus, exactly and by the index."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.docs import strip_leading_doc
from chunkloom.functions.text import stripped_or_original
from chunkloom.operators.embedding import HashedTf, embed
from chunkloom.operators.metrics import metrics, ranks_of_relevant
from chunkloom.operators.search import exact_topk
from chunkloom.operators.sharding import keep_first


def split_key(split: str) -> str:
    """test and eval_test mean the same."""
    return split if split.startswith("eval_") else f"eval_{split}"


def eval_queries(chunks: DataFrame, split: str) -> DataFrame:
    """(qid, cid, query_text): the split's chunks that have a query; the relevant document is the chunk itself."""
    rows = chunks.where((F.col("eval_split") == split_key(split)) & (F.col("query_text") != ""))
    return rows.select(F.col("chunk_id").alias("qid"), F.col("chunk_id").alias("cid"), "query_text")


def eval_corpus(chunks: DataFrame, strip: bool = True) -> DataFrame:
    """(cid, text): the body to search, without the documentation that the query may come from."""
    body = stripped_or_original(strip_leading_doc("text", F.lower(F.coalesce("language", F.lit("")))), F.col("text")) if strip else F.coalesce(F.nullif("text", F.lit("")), F.lit(" "))
    return chunks.select(F.col("chunk_id").alias("cid"), body.alias("text"))


def distinct_chunks(chunks: DataFrame) -> DataFrame:
    """One row per chunk_id, the latest snapshot of those that differ only there."""
    columns = ["chunk_id", "language", "text", "query_text", "eval_split", "corpus_snapshot"]
    return keep_first(chunks.select(*columns), ["chunk_id"], ["corpus_snapshot"])


def hits(chunks: DataFrame, split: str = "test", k: int = 100, strip: bool = True, make=None, metric: str = "cosine") -> tuple[DataFrame, DataFrame]:
    """(queries, hits) by exact search with an engine, the hashed-TF one if none is given."""
    make = make or partial(HashedTf, embed_dim=256, normalize=False)
    rows = distinct_chunks(chunks)
    queries = eval_queries(rows, split)
    q = embed(queries, make, "query_text", keep=["qid"], queries=True)
    c = embed(eval_corpus(rows, strip), make, "text", keep=["cid"])
    return queries, exact_topk(q, c, k, metric)


def retrieval_ranks(chunks: DataFrame, split: str = "test", k: int = 100, strip: bool = True) -> DataFrame:
    """(qid, rank) of every query; null where the relevant chunk is not among the k best."""
    queries, found = hits(chunks, split, k, strip)
    return ranks_of_relevant(queries, found)


def report(chunks: DataFrame, split: str = "test", ks: tuple[int, ...] = (1, 5, 10, 100), strip: bool = True) -> DataFrame:
    """One row: counts and metrics of a split.  Raises ValueError where there are no queries or no corpus."""
    if eval_queries(chunks, split).isEmpty():
        raise ValueError(f"no queries in {split_key(split)}")
    return metrics(retrieval_ranks(chunks, split, max(*ks, 10), strip), list(ks))


def mteb_benchmark(*_args, **_kwargs):
    """The external benchmark needs its own package and data."""
    raise NotImplementedError("the external benchmark is not available offline")
