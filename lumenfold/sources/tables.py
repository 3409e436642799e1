"""Sinks and sources of side tables: everything small is Parquet or CSV, everything large is partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.functions.names import chunk_number

POINTS = "`axis-0` double, `axis-1` double, `axis-2` double"


def write_volume(blocks: DataFrame, path: str, *parts: str, resume: bool = True) -> None:
    """Blocks in zstd Parquet, one folder per value of the partition columns; an existing result stays if resume."""
    w = blocks.repartition(*parts) if parts else blocks
    w.write.mode("ignore" if resume else "errorifexists").option("compression", "zstd").partitionBy(*parts).parquet(path)


def write_planes(vox: DataFrame, path: str, *parts: str) -> None:
    """Planes in folders by their keys (channel, z, ...), so a single plane is read by partition pruning."""
    vox.repartition(*parts).sortWithinPartitions(*parts).write.mode("errorifexists").partitionBy(*parts).parquet(path)


def write_points(points: DataFrame, path: str) -> None:
    points.write.mode("errorifexists").option("header", True).csv(path)


def read_chunk_points(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """Chunk CSVs with their chunk number and row order (file, then line)."""
    d = spark.read.schema(POINTS).option("header", True).option("pathGlobFilter", pattern).csv(path)
    name = F.regexp_extract(F.input_file_name(), r"([^/]*)$", 1)
    return d.select(chunk_number(name, "napari_chunk_").alias("chunk"), F.monotonically_increasing_id().alias("row"), F.col("`axis-0`").alias("axis_0"), F.col("`axis-1`").alias("axis_1"), F.col("`axis-2`").alias("axis_2"))
