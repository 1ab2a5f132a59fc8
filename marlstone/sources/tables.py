"""Scans of the Parquet tables and of delimited trip files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Delimited files with a header under an explicit schema; an empty field is null."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("nullValue", "").csv(path)
