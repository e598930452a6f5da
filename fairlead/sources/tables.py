"""Reading tables that are kept as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df for costly work on each row: dealt anew to all cores if it comes from fewer files than there are cores, as a file of one
    row group is read by one task, however it is split. Tables of many files, as a cluster has, are left where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < 4 * cores and len(df.inputFiles()) < cores
    return df.repartition(cores) if few else df
