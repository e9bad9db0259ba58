"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text listings (CLI output, kernel logs) as ``DataFrame[value string]``."""
    return spark.read.text(path)


def file_listing(spark: SparkSession, path: str, with_content: bool = False) -> DataFrame:
    """Files under ``path`` as ``(path, modificationTime, length[, content])``.
    Without ``content`` the bytes are never read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    cols = ["path", "modificationTime", "length"] + (["content"] if with_content else [])
    return df.select(*cols)
