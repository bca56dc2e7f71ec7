"""Ranks and retrieval metrics for queries with one relevant document each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.vectors import reciprocal_gain


def ranks_of_relevant(relevant: DataFrame, hits: DataFrame, qid: str = "qid", cid: str = "cid") -> DataFrame:
    """(qid, rank): the rank from 0 of each query's relevant document, null where it was not retrieved."""
    got = hits.select(qid, F.col(cid).alias("_cid"), "rank")
    joined = relevant.select(qid, F.col(cid).alias("_want")).join(got, qid, "left").where(F.col("_cid").isNull() | (F.col("_cid") == F.col("_want")))
    return relevant.select(qid).join(joined.groupBy(qid).agg(F.min("rank").alias("rank")), qid, "left")


def metrics(ranks: DataFrame, ks: list[int], by: list[str] | None = None, digits: int = 9) -> DataFrame:
    """n_queries, recall_at_k, mrr_at_10 and ndcg_at_10 over all queries, or per group; no queries give one row of n 0
    and nulls."""
    r = F.col("rank")
    recalls = [F.round(F.avg(F.when(r < k, 1.0).otherwise(0.0)), digits).alias(f"recall_at_{k}") for k in ks]
    mrr = F.round(F.avg(F.when(r < 10, 1.0 / (r + 1)).otherwise(0.0)), digits).alias("mrr_at_10")
    ndcg = F.round(F.avg(reciprocal_gain(r, 10)), digits).alias("ndcg_at_10")
    return ranks.groupBy(*(by or [])).agg(F.count("*").alias("n_queries"), *recalls, mrr, ndcg)
