"""Reading the given tables, and tables written between two steps."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lodgetrail.sources import scratch


#: The folder that holds this package.
_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package too, from wherever the driver was started.
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: a lost executor recomputes nothing above it."""
    spark = df.sparkSession
    path = scratch.fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
