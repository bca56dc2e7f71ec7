"""Resumable work with Structured Streaming: every micro-batch is committed once, and a second run adds nothing."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.sources import fs

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, root: str, schema, glob: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    """Files that appear below a folder, in bounded micro-batches."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).parquet(root)


def current_checkpoint(spark: SparkSession, checkpoint: str, begin_anew: bool = False) -> str:
    """The checkpoint folder in use below a name: a marker beside it holds the number of the run that began last."""
    marker = f"{checkpoint}.run"
    n = int(fs.read_bytes(spark, marker)) if fs.exists(spark, marker) else 0
    if begin_anew:
        n += 1
        fs.write_bytes(spark, marker, str(n).encode())
    return f"{checkpoint}-{n}" if n else checkpoint


def read_sink(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all micro-batches that a sink holds."""
    return spark.read.parquet(f"{out}/batch=*")


def run_once(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, resume: bool = True) -> int:
    """Transforms what is new and appends it below out/batch=<run>-<n>; returns the number of rows the sink holds then.

    A micro-batch that is repeated after a failure overwrites its own folder, so the sink has each row once.
    resume=False empties the sink and begins anew under a checkpoint folder of its own, which later runs resume.
    """
    spark = stream.sparkSession
    folder = current_checkpoint(spark, checkpoint, not resume)
    if not resume:
        fs.delete(spark, out)
    # batch numbers begin at 0 in each checkpoint, so the folder's name goes before them
    name = hashlib.md5(folder.encode()).hexdigest()[:8]

    def sink(batch: DataFrame, n: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={name}-{n}")

    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", folder).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_sink(spark, out).count() if fs.glob(spark, f"{out}/batch=*") else 0


def embed_stream(stream: DataFrame, embed: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, resume: bool = True) -> int:
    """Embeds new chunk rows.  A chunk_id that repeats, in one micro-batch or in a later one, is embedded once: the ids seen
    are the stream's state, which the checkpoint keeps with each batch, so a repeated batch gives the same rows."""
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE, None)
    conf.set(STATE_STORE, ROCKS_DB)  # the ids lie on disk, so their number is not bounded by memory
    try:
        return run_once(stream.where("chunk_id is not null").dropDuplicates(["chunk_id"]), embed, out, checkpoint, resume)
    finally:
        conf.unset(STATE_STORE) if before is None else conf.set(STATE_STORE, before)


def complete(counted: DataFrame, out: str, checkpoint: str) -> None:
    """Runs an aggregating stream over what is there and writes its whole result."""

    def sink(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    counted.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def status_counts(stream: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Status messages per window of the time logged, status and language; what comes later than `late` is dropped.

    The same message received twice counts once.
    """
    rows = stream.where("shard_id is not null").withColumns({"logged": F.col("logged_at").cast("timestamp"), "language": F.coalesce("language", F.lit(""))})
    once = rows.withWatermark("logged", late).dropDuplicates(["shard_id", "status", "logged", "language"])
    return once.groupBy(F.window("logged", width), "status", "language").agg(F.count("*").alias("messages"), F.sum("row_total").alias("rows"))
