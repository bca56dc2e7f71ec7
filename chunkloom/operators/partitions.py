"""How rows lie in tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """df dealt round to as many tasks as the cluster has cores, if it has fewer input splits than that.

    Small tables are often one file with one row group, which one task would read and work on alone.  Tables of
    more splits than cores are left as they are, so nothing is shuffled where it would cost much.  Meant for scans,
    filters and projections: the splits are counted without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    if "Exchange" in plan.executedPlan().toString():  # counting the splits would run it
        return df
    splits = plan.toRdd().getNumPartitions()
    return df.repartition(cores) if 0 < splits < cores else df
