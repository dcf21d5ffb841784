"""Output columns as data.

A ``Rule`` names one output column, where its value comes from and how it is
converted. A source is a dotted path into the input schema (``"usr_uuid"``,
``"server.locus_hotel.location_id"``) or a ``Constant``. A path the input does
not have reads as NULL, which is how older input layouts are tolerated.

Rules may take their value from elsewhere on some funnel steps. Compiled for
one step, such a rule is a plain column reference; compiled without a step it
is a CASE on the step column.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType, StructType

from lodgetrail.functions import scalars

_SECONDS = "try_cast(try_cast({0} AS double) / 1000 AS bigint)"
# The conversions of ``functions.scalars`` as SQL expressions.
CONVERSIONS = {
    "upper": "upper({0})",
    "lower": "lower({0})",
    "join": "concat_ws(',', {0})",
    "first": "get({0}, 0)",
    "timestamp_text": f"from_unixtime({_SECONDS}, '{scalars.TIMESTAMP_TEXT}')",
    "day_text": f"from_unixtime({_SECONDS}, '{scalars.DAY_TEXT}')",
}

# Conversions that have a result for every value.
LOSSLESS = ("upper", "lower", "join", "first", "string")
# What the names of flags for lost values start with.
LOST = "_lost_"


@dataclass(frozen=True)
class Constant:
    """A constant, as an SQL expression."""

    sql: str


EMPTY = Constant("''")


def null(to: str) -> Constant:
    return Constant(f"CAST(NULL AS {to})")


Source = str | Constant


@dataclass(frozen=True)
class Rule:
    target: str
    source: Source
    convert: str | None = None
    on_step: Mapping[str, Source] = field(default_factory=dict)

    def sources(self) -> list[Source]:
        return [self.source, *self.on_step.values()]


def rule(target: str, source: Source | None = None, convert: str | None = None, **on_step: Source) -> Rule:
    """``convert`` is a key of ``CONVERSIONS`` or a type to cast to."""
    return Rule(target, target if source is None else source, convert, on_step)


def carry(*names: str) -> list[Rule]:
    return [rule(name) for name in names]


def type_at(schema: StructType, path: str) -> DataType | None:
    """Type at a dotted path, looking through arrays of structs; None where absent."""
    found: DataType = schema
    for name in path.split("."):
        while isinstance(found, ArrayType):
            found = found.elementType
        if not isinstance(found, StructType) or name not in found.names:
            return None
        found = found[name].dataType
    return found


def value_at(schema: StructType, path: str, missing: DataType | str = "string") -> Column:
    """The column at a path, or a NULL of type ``missing`` where the input lacks it."""
    return F.col(path) if type_at(schema, path) is not None else scalars.typed_null(missing)


def _missing_type(spec: Rule, schema: StructType) -> DataType | str:
    """What a source the input lacks is a NULL of: the type of the rule's other sources."""
    found = [type_at(schema, s) for s in spec.sources() if isinstance(s, str)]
    return next((t for t in found if t is not None), "string")


def _expression(spec: Rule, schema: StructType, source: Source) -> str:
    if isinstance(source, Constant):
        value = source.sql
    elif type_at(schema, source) is not None:
        value = ".".join(f"`{name}`" for name in source.split("."))
    else:
        missing = _missing_type(spec, schema)
        value = null(missing if isinstance(missing, str) else missing.simpleString()).sql
        # A lacking path has no first element to take.
        if spec.convert == "first":
            return value
    if spec.convert is None:
        return value
    text, of_text = value, isinstance(source, str) and isinstance(type_at(schema, source), StringType)
    if spec.convert in scalars.WHOLE and of_text:
        value = scalars.WHOLE_TEXT.format(value)
    converted = CONVERSIONS.get(spec.convert, f"try_cast({{0}} AS {spec.convert})").format(value)
    if of_text and spec.convert in scalars.TEXT_LIKE:
        return f"IF({text} RLIKE r'{scalars.TEXT_LIKE[spec.convert]}', {converted}, NULL)"
    return converted


def _constant_type(constant: Constant) -> DataType:
    cast = re.fullmatch(r"CAST\(NULL AS (.+)\)", constant.sql)
    return DataType.fromDDL(cast[1]) if cast else StringType()


def _case_type(spec: Rule, schema: StructType) -> str | None:
    """What all branches of an unfolded CASE are converted to, where they are of unlike types.

    As where branches are put together by union: unlike numbers widen, which
    Spark does by itself; numbers win over text, and text over the rest.
    """
    if spec.convert not in (None, "first"):
        return None
    missing = _missing_type(spec, schema)
    found = set()
    for source in spec.sources():
        held = _constant_type(source) if isinstance(source, Constant) else type_at(schema, source)
        if held is None:
            held = StringType() if missing == "string" else missing
        found.add(held.elementType if spec.convert == "first" and isinstance(held, ArrayType) else held)
    if len(found) < 2 or all(isinstance(t, NumericType) for t in found):
        return None
    return "double" if any(isinstance(t, NumericType) for t in found) else "string"


def expression(
    spec: Rule, schema: StructType, step: str | None = None, step_column: str = "meta_fnnl_step"
) -> str:
    """The rule as an SQL expression named after its target."""
    value = _expression(spec, schema, spec.source if step is None else spec.on_step.get(step, spec.source))
    if step is None and spec.on_step:
        one = _case_type(spec, schema)

        def branch(sql: str) -> str:
            return sql if one is None else f"try_cast({sql} AS {one})"

        value = branch(value)
        cases = " ".join(
            f"WHEN `{step_column}` = '{on}' THEN {branch(_expression(spec, schema, source))}"
            for on, source in spec.on_step.items()
        )
        value = f"CASE {cases} ELSE {value} END"
    return f"{value} AS `{spec.target}`"


def _lost_flag(spec: Rule, schema: StructType, step: str | None, step_column: str) -> str:
    """Whether the rule's conversion turns a value into NULL, as an SQL expression. Blank text is no value."""

    def lost(source: Source) -> str:
        if isinstance(source, Constant) or type_at(schema, source) is None:
            return "false"
        value = ".".join(f"`{name}`" for name in source.split("."))
        return f"(trim(CAST({value} AS string)) <> '' AND ({_expression(spec, schema, source)}) IS NULL)"

    if step is not None or not spec.on_step:
        flag = lost(spec.source if step is None else spec.on_step.get(step, spec.source))
    else:
        cases = " ".join(f"WHEN `{step_column}` = '{on}' THEN {lost(source)}" for on, source in spec.on_step.items())
        flag = f"CASE {cases} ELSE {lost(spec.source)} END"
    return f"coalesce({flag}, false) AS `{LOST}{spec.target}`"


def project(
    df: DataFrame,
    rules: Iterable[Rule],
    step: str | None = None,
    step_column: str = "meta_fnnl_step",
    flag_lost: bool = False,
) -> DataFrame:
    """Select exactly the rules' columns, in order.

    They go to Spark as one list of expressions: building hundreds of columns
    through the Column API takes seconds of driver time. With ``flag_lost``,
    flags named after ``LOST`` and the target follow, which tell where a
    conversion lost a value; flags that the input has are kept.
    """
    schema, rules = df.schema, list(rules)
    expressions = [expression(spec, schema, step, step_column) for spec in rules]
    if flag_lost:
        expressions += [f"`{c}`" for c in df.columns if c.startswith(LOST)]
        expressions += [
            _lost_flag(spec, schema, step, step_column) for spec in rules if spec.convert not in (None, *LOSSLESS)
        ]
    return df.selectExpr(*expressions)


def paths(rules: Iterable[Rule]) -> set[str]:
    """Every input path the rules may read."""
    return {s for spec in rules for s in spec.sources() if isinstance(s, str)}
