"""Loading the dimension and preparing raw events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgetrail.functions import columns
from lodgetrail.operators import enrich
from lodgetrail.plans import layout
from lodgetrail.sources import readers

# The dimension's columns as they appear in the facts.
HOTEL_KEY = "mmt_hotel_id"
CITY = "htl_city_code"


def hotel_cities(hotels: DataFrame) -> DataFrame:
    """Distinct (hotel, city), the city also in upper case. A hotel may have several."""
    return (
        hotels.select(F.col("hotel_id").alias(HOTEL_KEY), "city_code")
        .withColumn(CITY, F.upper("city_code"))
        .dropDuplicates()
    )


def load_hotels(spark: SparkSession, path: str) -> DataFrame:
    return hotel_cities(readers.read_delimited(spark, path, ["hotel_id", "city_code"]))


def has_location(events: DataFrame) -> bool:
    """Whether events come in the current layout, which has the location struct."""
    return columns.type_at(events.schema, layout.LOCATION) is not None


def prepare_events(raw: DataFrame, flag_lost: bool = False) -> DataFrame:
    """Raw events of either layout as the columns the steps work on.

    Columns the input lacks read as NULL. A flag of rows in the older layout is
    kept. With ``flag_lost``, values that a conversion loses are flagged, here
    and in the facts made of these events.
    """
    rules = layout.prepared_columns(has_location(raw))
    if layout.OLDER in raw.columns:
        rules = [*rules, columns.rule(layout.OLDER)]
    return columns.project(raw, rules, flag_lost=flag_lost)


def with_city(facts: DataFrame, hotels: DataFrame) -> DataFrame:
    """The city in upper case follows from the city, so it is worked out here and not sent along."""
    return enrich.attach(facts, hotels.drop(CITY), "hotel_id", HOTEL_KEY).withColumn(CITY, F.upper("city_code"))
