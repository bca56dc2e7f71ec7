"""Deduplication, global order, shards and their manifest.

Row numbers over a whole language don't go through one task: rows are range-partitioned by (language, key),
counted per partition, and numbered from the partitions' offsets, so a language may be of any size.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reliable(df: DataFrame) -> DataFrame:
    """df written once to the folder of spark.checkpoint.dir; local sessions without one get a temporary folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = os.path.join(tempfile.gettempdir(), f"chunkloom-{uuid.uuid4().hex}")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by the order columns and then by all others.

    It is an aggregate with partial results before the shuffle, so a key with very many copies is reduced where
    its rows lie.  Null keys are keys of their own.
    """
    rest = [c for c in df.columns if c not in keys]
    by = [c for c in order if c not in keys] + [c for c in rest if c not in order and not df.schema[c].dataType.simpleString().startswith("map")]
    best = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in by])).alias("_row")
    return df.groupBy(*keys).agg(best).select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """(rows, distinct_keys, duplicates)."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per.agg(rows.alias("rows"), F.count("*").alias("distinct_keys"), (rows - F.count("*")).alias("duplicates"))


def number_rows(df: DataFrame, group: str, order: list[str], name: str = "row_no") -> DataFrame:
    """Adds the position from 0 of each row within its group by the order columns, which must be unique in it."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, F.col(f"`{group}`"), *[F.col(f"`{c}`") for c in order]).sortWithinPartitions(group, *order)
    placed = reliable(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("_before", before).select("_part", F.col(f"`{group}`").alias("_group"), "_first", "_before")
    # a row per partition and group; how it is joined is left to the planner
    joined = placed.join(offsets, (placed["_part"] == offsets["_part"]) & placed[f"`{group}`"].eqNullSafe(offsets["_group"]))
    return joined.select(*[placed[f"`{c}`"] for c in df.columns], (F.col("_at") - F.col("_first") + F.col("_before")).alias(name))


def language_position(languages: list[str]) -> Column:
    """Place of a language in the configured order; others follow."""
    return F.coalesce(*[F.when(F.col("language") == v, F.lit(i)) for i, v in enumerate(languages)], F.lit(len(languages)))


def assign_shards(df: DataFrame, target: int, languages: list[str], order: list[str] | None = None) -> DataFrame:
    """Adds shard_id and row_in_shard: consecutive slices of `target` rows per language, numbered across languages in
    the configured order (others behind, by name).  The keys must be unique within a language."""
    numbered = number_rows(df, "language", order or ["chunk_id"])
    sized = numbered.withColumns({"_slice": F.floor(F.col("row_no") / target).cast("int"), "row_in_shard": (F.col("row_no") % target).cast("int")})
    slices = sized.groupBy("language", "_slice").agg(F.count("*").alias("_n"))
    ids = slices.withColumn("shard_id", (F.row_number().over(Window.orderBy(language_position(languages), "language", "_slice")) - 1).cast("int"))
    return sized.join(ids.select(F.col("language").alias("_language"), F.col("_slice").alias("_at"), "shard_id"), F.col("language").eqNullSafe(F.col("_language")) & (F.col("_slice") == F.col("_at"))).drop("_slice", "_at", "_language", "row_no")


def folder_name(language: Column) -> Column:
    """A language as part of a path; there is no folder of an empty name."""
    return F.coalesce(F.nullif(language, F.lit("")), F.lit("__none__"))


def manifest(assigned: DataFrame, root: str = "") -> DataFrame:
    """One row per shard, in the manifest's schema.  A shard's Parquet "file" is a folder of that name."""
    file = F.format_string("%sshards/lang=%s/shard-%05d.parquet", F.lit(root), folder_name(F.col("language")), F.col("shard_id"))
    npy = F.format_string("%svectors/lang=%s/shard-%05d.npy", F.lit(root), folder_name(F.col("language")), F.col("shard_id"))
    counted = assigned.groupBy("shard_id", "language").agg(F.count("*").cast("int").alias("approx_chunks"))
    return counted.select("shard_id", "language", F.array(file).alias("input_files"), "approx_chunks", file.alias("out_parquet"), npy.alias("out_npy"), F.lit("pending").alias("status"))


def latest_status(log: DataFrame) -> DataFrame:
    """(shard_id, status, logged_at) of the last entry per shard by the time logged, then received, then name."""
    return log.where("shard_id is not null").groupBy("shard_id").agg(F.max_by(F.struct("status", "logged_at"), F.struct("logged_at", "received_at", "status")).alias("s")).select("shard_id", "s.status", "s.logged_at")


def pending_shards(shards: DataFrame, log: DataFrame) -> DataFrame:
    """Shards of the manifest that are not done; a shard without status is pending."""
    done = latest_status(log).where("status = 'done'").select("shard_id")
    return shards.join(done, "shard_id", "left_anti")


def with_status(shards: DataFrame, log: DataFrame) -> DataFrame:
    """The manifest with each shard's last status, pending where there is none."""
    last = latest_status(log).select("shard_id", F.col("status").alias("_status"))
    return shards.join(last, "shard_id", "left").withColumn("status", F.coalesce("_status", F.lit("pending"))).drop("_status")


def remaining_rows(rows: DataFrame, committed: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows whose key is not committed yet."""
    return rows.join(committed.select(key).distinct(), key, "left_anti")


def reconcile(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """(shard_id, expected, got) of the shards whose row counts differ from the manifest's."""
    got = rows.groupBy("shard_id").agg(F.count("*").alias("got"))
    expected = shards.select("shard_id", F.col("approx_chunks").cast("bigint").alias("expected"))
    return expected.join(got, "shard_id", "full").select("shard_id", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("got", F.lit(0)).alias("got")).where("expected <> got")


def totals(shards: DataFrame) -> DataFrame:
    """One row: languages, chunks and shards of a manifest."""
    return shards.agg(F.countDistinct("language").alias("languages"), F.coalesce(F.sum("approx_chunks"), F.lit(0)).cast("bigint").alias("chunks"), F.count("*").alias("shards"))


def cap_per_group(df: DataFrame, group: str, n: int, order: list[str]) -> DataFrame:
    """The first n rows of each group by the order columns; 0 means all.  Each task keeps n per group before the shuffle."""
    if n <= 0:
        return df
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def sample(df: DataFrame, n: int, key: str, seed: int, hash_fn: str = "md5") -> DataFrame:
    """n rows without replacement, the same ones however the rows are partitioned: the least hashes of (seed, key).

    Rows are counted by the hash's first four digits (65,536 counts at most); all below the digits at which n is reached
    are taken where they lie, and only the rows with just these digits are sorted.
    """
    salted = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    digest = F.md5(salted) if hash_fn == "md5" else F.lower(F.lpad(F.hex(F.xxhash64(F.lit(seed), key)), 16, "0"))
    hashed = df.withColumn("_h", F.coalesce(digest, F.lit("")))
    front = F.substring("_h", 1, 4)
    before, cut = 0, None
    for r in hashed.groupBy(front.alias("f")).agg(F.count("*").alias("n")).orderBy("f").collect():
        if before + r.n >= n:
            cut = r.f
            break
        before += r.n
    if cut is None:
        return df
    rest = hashed.where(front == cut).orderBy("_h", key).limit(n - before)
    return hashed.where(front < cut).unionByName(rest).drop("_h")


def union_runs(runs: dict[str, DataFrame]) -> DataFrame:
    """All runs with their name in `run`; columns that a run lacks are null."""
    out = None
    for name, df in runs.items():
        part = df.withColumn("run", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no runs")
    return out
