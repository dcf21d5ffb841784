"""Predicates on funnel steps, ranks and coupon statuses.

All follow SQL's three-valued logic: a NULL step satisfies neither a step test
nor its negation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def on_step(step: Column, name: str) -> Column:
    """Case-sensitive step test."""
    return step == F.lit(name)


def off_steps(step: Column, *names: str) -> Column:
    """On none of the named steps."""
    return ~step.isin(*names) if len(names) > 1 else step != F.lit(names[0])


def needs_on_step(step: Column, name: str, needed: Column) -> Column:
    """Only rows on the named step must have a non-NULL ``needed``."""
    return F.when(step == F.lit(name), needed.isNotNull()).otherwise(F.lit(True))


def at_most(rank: Column, n: int = 1) -> Column:
    return rank <= F.lit(n)


def is_or_null(value: Column, wanted: str) -> Column:
    return (value == F.lit(wanted)) | value.isNull()


def at_position_or_null(position: Column, chosen: Column, status: Column) -> Column:
    """At the chosen position, or carrying no status at all."""
    return (position == chosen) | status.isNull()
