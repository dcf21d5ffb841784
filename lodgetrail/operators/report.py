"""Employee report: full names, and the steps from the ground floor to each desk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodgetrail.functions import scalars


def desk_report(employees: DataFrame, steps_per_floor: int) -> DataFrame:
    return employees.select(
        "id",
        scalars.joined_words(F.col("first_name"), F.col("second_name")).alias("name"),
        (F.col("floor") * F.lit(steps_per_floor)).alias("steps_to_desk"),
    )


def rows_and_mean(df: DataFrame, measure: str) -> DataFrame:
    """One row: the row count and the mean of a column."""
    return df.agg(F.count("*").alias("rows"), F.mean(measure).alias(f"avg_{measure}"))
