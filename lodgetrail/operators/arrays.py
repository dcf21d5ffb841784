"""Opening arrays held inside a row, and choosing inside them without opening."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def open_array(
    df: DataFrame, array: str | Column, element: str, position: str | None = None, outer: bool = True
) -> DataFrame:
    """One row per element, keeping every other column.

    With ``outer``, rows whose array is NULL or empty stay, with NULL element
    and position. Positions count from 0.
    """
    if position is None:
        opened = (F.explode_outer if outer else F.explode)(array).alias(element)
    else:
        opened = (F.posexplode_outer if outer else F.posexplode)(array).alias(position, element)
    return df.select("*", opened)


def matched_pairs(
    left: Column,
    right: Column,
    key: str,
    names: tuple[str, str, str] = ("position", "left", "right"),
) -> Column:
    """Equi-match of two struct arrays of one row, as an array of pairs.

    Each pair holds the left element's position, the left and the right
    element. Duplicates on either side all pair up; NULL keys never match.
    Matching before opening keeps the two arrays out of the opened rows.
    """
    position, left_name, right_name = names

    def pairs_of(l: Column, i: Column) -> Column:
        same = F.filter(right, lambda r: r.getField(key) == l.getField(key))
        return F.transform(same, lambda r: F.struct(i.alias(position), l.alias(left_name), r.alias(right_name)))

    return F.flatten(F.transform(left, pairs_of))


def no_element(array: Column) -> Column:
    """A NULL of the array's element type."""
    return F.get(array, F.lit(-1))


def kept_elements(array: Column, keep: Callable[[Column, Column], Column]) -> Column:
    """The elements for which ``keep(element, position)`` holds.

    A NULL or empty array becomes one NULL element, so that a plain explode of
    the result equals an outer explode of the array followed by a filter that
    lets NULLs pass; an array of which nothing is kept gives no rows.
    """
    kept = F.filter(array, keep)
    return F.when(F.size(array) > 0, kept).otherwise(F.array(no_element(array)))


def first_positions(array: Column, field: str, values: tuple[str, ...]) -> list[Column]:
    """For each value, the 0-based position of the first element whose field equals it."""
    held = array.getField(field)
    return [(F.nullif(F.array_position(held, F.lit(v)), F.lit(0).cast("bigint")) - 1).cast("int") for v in values]


def picked_elements(array: Column, chosen: Column, status: str, keep_unmatched: bool = False) -> Column:
    """The element at the chosen position and those whose status is NULL.

    With ``keep_unmatched``, a NULL position keeps all. A NULL or empty array
    becomes one NULL element, as in ``kept_elements``. The position is used
    outside of any lambda, so it is worked out once per row, not per element.
    """
    at_position = F.filter(F.array(F.get(array, chosen)), lambda e: e.getField(status).isNotNull())
    kept = F.concat(at_position, F.filter(array, lambda e: e.getField(status).isNull()))
    if keep_unmatched:
        kept = F.when(chosen.isNull(), array).otherwise(kept)
    return F.when(F.size(array) > 0, kept).otherwise(F.array(no_element(array)))


def least_keys(array: Column, order: Callable[[Column], list[Column]]) -> Column:
    """Order keys of the smallest element by ``order``, as a struct ending in its ``position``.

    Equal elements rank by position. NULL for a NULL or empty array.
    """
    return F.array_min(
        F.transform(
            array,
            lambda e, i: F.struct(*[k.alias(f"k{n}") for n, k in enumerate(order(e))], i.alias("position")),
        )
    )
