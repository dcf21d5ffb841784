"""Prepared events to facts, one function per kind of funnel step.

Whatever can be chosen inside an event's own arrays is chosen there, before
opening them: only the winning tariff and the coupons that stay are ever put on
rows of their own, and no shuffle carries more than one row per event. Shuffles
happen only where events sharing a row id must be compared, and not even then
if the caller knows or has measured that row ids are unique.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from lodgetrail.functions import columns, scalars
from lodgetrail.operators import arrays, filters, packed, pick
from lodgetrail.plans import layout as names

# How events relate to their row ids.
SHARED = "shared"  # several events may have one: compare across events
UNIQUE = "unique"  # one event each: no shuffle
FEW_SHARED = "few_shared"  # few ids are shared: only their events are compared

OFFER_ORDER = "offer"
EVENT_PRICE_ORDER = "event_price"

_NO_COUPONS = "array<struct<cpn_status:string>>"
# What an array of structs is taken for where the input does not have it.
_ABSENT = {
    names.TARIFFS: f"array<struct<pd_htl_rm_cd:string,{names.TARIFF_COUPONS}:{_NO_COUPONS}>>",
    names.DISPLAYED: "array<struct<pd_htl_id:string>>",
    names.SERVER_HOTELS: f"array<struct<pd_htl_id:string,{names.SERVER_COUPONS}:{_NO_COUPONS}>>",
    names.EVENT_COUPONS: _NO_COUPONS,
}

STATUS = "cpn_status"
# Beyond price and position, equal tariffs of events sharing a row id rank by these.
TIE_BREAK = ("record_pdt_ts", "meta_rq_id")


def structs_at(schema: StructType, path: str) -> Column:
    """An array of structs, or a NULL one where the input has none there."""
    found = columns.type_at(schema, path)
    if isinstance(found, ArrayType):
        return F.col(path)
    fallback = _ABSENT.get(path, _NO_COUPONS)
    return scalars.typed_null(fallback)


def has_rank(schema: StructType) -> bool:
    """Whether server hotels have a rank. Where they were not opened, nothing depends on it."""
    return columns.type_at(schema, "server") is None or columns.type_at(schema, "server.pd_htl_rank") is not None


def fact_rules(schema: StructType) -> list[columns.Rule]:
    """The rules of the fact columns, for opened events of this schema."""
    # The older layout's location is a constant text, not a struct.
    location = columns.type_at(schema, names.LOCATION)
    return names.fact_columns(isinstance(location, StructType), has_rank(schema))


def project_facts(
    opened: DataFrame, rules: Sequence[columns.Rule], step: str | None = None, flag_lost: bool = False
) -> DataFrame:
    """The fact columns; rows of files in the older layout have that layout's constants for locations.

    These are texts: a column of another type is NULL there.
    """
    if names.OLDER not in opened.columns:
        return columns.project(opened, rules, step, flag_lost=flag_lost)
    flagged = columns.project(opened, [*rules, columns.rule(names.OLDER)], step, flag_lost=flag_lost)

    def column(name: str, of: DataType) -> str:
        if name in names.EMPTY_IN_OLDER and isinstance(of, StringType):
            return f"IF(`{names.OLDER}`, '', `{name}`) AS `{name}`"
        if name in names.EMPTY_IN_OLDER or name in names.NULL_IN_OLDER:
            return f"IF(`{names.OLDER}`, NULL, `{name}`) AS `{name}`"
        return f"`{name}`"

    return flagged.selectExpr(*[column(f.name, f.dataType) for f in flagged.schema if f.name != names.OLDER])


def _sources(events: DataFrame, step: str) -> set[str]:
    """The events' own columns that the facts of a step are made of."""
    wanted = {spec.on_step.get(step, spec.source) for spec in fact_rules(events.schema)}
    heads = {source.partition(".")[0] for source in wanted if isinstance(source, str)}
    return {c for c in events.columns if c in heads or c == names.OLDER or c.startswith(columns.LOST)}


def _facts(opened: DataFrame, step: str | None) -> DataFrame:
    flag_lost = any(c.startswith(columns.LOST) for c in opened.columns)
    return project_facts(opened, fact_rules(opened.schema), step, flag_lost)


def tariff_order(order: str, schema: StructType):
    """The sort keys of a tariff, by the order's name."""
    fields = columns.type_at(schema, names.TARIFFS)
    held = fields.elementType.names if isinstance(fields, ArrayType) else []

    def field(element: Column, name: str, missing: str) -> Column:
        return element.getField(name) if name in held else scalars.typed_null(missing)

    def flagged(element: Column) -> Column:
        return scalars.lenient(field(element, "pd_htl_lowest_trff", "boolean"), "boolean").eqNullSafe(True)

    def by_offer(element: Column) -> list[Column]:
        price = scalars.lenient(field(element, "prc_sell_amt_w_tax", "double"), "double")
        return [~flagged(element), price.isNull(), price]

    def by_event_price(element: Column) -> list[Column]:
        event_price = scalars.lenient(columns.value_at(schema, "prc_sell_amt_w_tax"), "double")
        return [scalars.price_weight(flagged(element), event_price)]

    return {OFFER_ORDER: by_offer, EVENT_PRICE_ORDER: by_event_price}[order]


def best_tariff(
    events: DataFrame,
    order: str = OFFER_ORDER,
    row_ids: str = SHARED,
    tie_break: Sequence[str] = TIE_BREAK,
) -> DataFrame:
    """Events with the winning tariff as a struct column; one event per row id.

    ``offer`` ranks flagged tariffs first, then by the tariff's own price with
    NULLs last. ``event_price`` ranks by the event's price, times 1000 where the
    tariff is not flagged, NULLs first. Equal tariffs rank by array position.
    Of events sharing a row id, only the one with the best tariff stays, those
    without tariffs ranking last (under ``event_price``: as unflagged ones).
    """
    keyed = _with_best_tariff(events, order)
    if row_ids == UNIQUE:
        return keyed.drop("_keys")
    flat = [f.name for f in events.schema.fields if f.name not in _ABSENT]
    # The tariff with its coupons, then all flat columns: events alike in these give equal facts.
    last = [F.col("tariff"), F.expr(f"xxhash64({', '.join(flat)})")]
    rank = [F.col(c) for c in ("_keys", *tie_break) if c in keyed.columns]
    return _of_rivals(keyed, row_ids, lambda rivals: pick.top_one(rivals, [names.ROW_ID], rank + last)).drop("_keys")


def _with_best_tariff(events: DataFrame, order: str) -> DataFrame:
    """Events with their own best tariff, and its order keys."""
    schema = events.schema
    tariffs = structs_at(schema, names.TARIFFS)
    ranked_by = tariff_order(order, schema)
    none = arrays.no_element(tariffs)
    last = F.lit(2147483647).alias("position")
    no_keys = F.struct(*[k.alias(f"k{n}") for n, k in enumerate(ranked_by(none))], last)
    return events.withColumn("_keys", F.coalesce(arrays.least_keys(tariffs, ranked_by), no_keys)).withColumn(
        "tariff", F.get(tariffs, F.col("_keys.position"))
    )


def _of_rivals(events: DataFrame, row_ids: str, top_one: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One event per row id, by ``top_one`` of those that share theirs."""
    if row_ids == SHARED:
        return top_one(events)
    # No hint: Spark broadcasts the ids if it measures few, whatever the caller stated.
    few = pick.shared_keys(events.select(names.ROW_ID), names.ROW_ID)
    alone = events.join(few, names.ROW_ID, "left_anti")
    rivals = events.join(few, names.ROW_ID, "left_semi")
    return alone.unionByName(top_one(rivals))


def _open_coupons(df: DataFrame, kept: Column) -> DataFrame:
    return df.select("*", F.explode(kept).alias("coupon"))


def detail_facts(
    prepared: DataFrame,
    tariff_order: str = OFFER_ORDER,
    row_ids: str = SHARED,
    keep_unmatched: bool = False,
    tie_break: Sequence[str] = TIE_BREAK,
) -> DataFrame:
    """Detail steps: the best tariff per row id, and of its coupons the preferred one."""
    events = prepared.where(filters.on_step(F.col(names.STEP), names.DETAIL) & F.col(names.ROW_ID).isNotNull())
    keyed = _with_best_tariff(events, tariff_order)
    # One event per row id will be left, so its own coupons decide: they are picked before events are compared.
    coupons = structs_at(keyed.schema, f"tariff.{names.TARIFF_COUPONS}")
    firsts = arrays.first_positions(coupons, STATUS, names.DETAIL_PRIORITIES)
    picked = arrays.picked_elements(coupons, F.coalesce(*firsts), STATUS, keep_unmatched)
    won = keyed.withColumn("_kept", picked)
    if columns.type_at(keyed.schema, f"tariff.{names.TARIFF_COUPONS}") is not None:
        won = won.withColumn("tariff", F.col("tariff").dropFields(names.TARIFF_COUPONS))
    if row_ids != UNIQUE:
        rank = [c for c in ("_keys", *tie_break) if c in won.columns]
        # Equal events rank by their packed columns, the tariff first: events alike in these give equal facts.
        last = [F.col(packed.PACKED).asc_nulls_last(), F.col(packed.WHOLE)]

        def top_one(rivals: DataFrame) -> DataFrame:
            return packed.shuffled(
                rivals.select("tariff", *[c for c in rivals.columns if c != "tariff"]),
                {"tariff", "_kept", *_sources(events, names.DETAIL)},
                {names.ROW_ID, *rank},
                lambda sent: pick.top_one(sent, [names.ROW_ID], [*map(F.col, rank), *last]),
                needed=F.size("_kept") > 0,
            )

        won = _of_rivals(won, row_ids, top_one)
    return _facts(_open_coupons(won, F.col("_kept")), names.DETAIL)


def display_expanded(prepared: DataFrame) -> DataFrame:
    """Non-detail events by displayed hotel; listing events need one with an id."""
    events = prepared.where(filters.off_steps(F.col(names.STEP), names.DETAIL))
    return _expand_display(events)


def _expand_display(events: DataFrame) -> DataFrame:
    displayed = structs_at(events.schema, names.DISPLAYED)
    return arrays.open_array(events, displayed, "shown", position="pos").where(
        filters.needs_on_step(F.col(names.STEP), names.LISTING, F.col("shown.pd_htl_id"))
    )


def listing_facts(prepared: DataFrame, listing_only: bool = True) -> DataFrame:
    """Listing steps: each displayed hotel with its server twin and recommended coupons.

    Without ``listing_only``, other non-detail events that hold both arrays
    take part too. Needs no shuffle.
    """
    step = F.col(names.STEP)
    on = filters.on_step(step, names.LISTING) if listing_only else filters.off_steps(step, names.DETAIL)
    events = prepared.where(on)
    displayed = structs_at(events.schema, names.DISPLAYED)
    hotels = structs_at(events.schema, names.SERVER_HOTELS)
    pairs = arrays.matched_pairs(displayed, hotels, "pd_htl_id", ("pos", "shown", "server"))
    held = columns.type_at(events.schema, f"{names.SERVER_HOTELS}.{names.SERVER_COUPONS}")

    def rows_of(pair: Column) -> Column:
        server = pair.getField("server")
        coupons = server.getField(names.SERVER_COUPONS) if isinstance(held, ArrayType) else scalars.typed_null(_NO_COUPONS)
        kept = arrays.kept_elements(
            coupons, lambda c, _: filters.is_or_null(c.getField(STATUS), names.LISTING_STATUS)
        )
        if held is not None:
            server = server.dropFields(names.SERVER_COUPONS)
        opened = [pair.getField("pos").alias("pos"), pair.getField("shown").alias("shown"), server.alias("server")]
        return F.transform(kept, lambda c: F.struct(*opened, c.alias("coupon")))

    # Pairs and their coupons are opened at once: each opening copies the event's columns.
    matched = events.withColumn("_row", F.explode(F.flatten(F.transform(pairs, rows_of)))).select("*", "_row.*").drop("_row")
    return _facts(matched, names.LISTING if listing_only else None)


def other_facts(prepared: DataFrame, row_ids: str = SHARED, keep_unmatched: bool = False) -> DataFrame:
    """All other steps: each displayed hotel with the event's preferred coupon.

    The preference is settled per row id, over all its events.
    """
    step = F.col(names.STEP)
    events = prepared.where(
        filters.off_steps(step, names.DETAIL, names.LISTING) & F.col(names.ROW_ID).isNotNull()
    )
    coupons = structs_at(events.schema, names.EVENT_COUPONS)
    priorities = arrays.first_positions(coupons, STATUS, names.OTHER_PRIORITIES)
    firsts = {f"_first{n}": position for n, position in enumerate(priorities)}
    own = F.coalesce(*priorities)
    if row_ids == UNIQUE:
        settled = events.withColumn("_chosen", own)
    else:
        narrow = events.select(names.ROW_ID, *[p.alias(n) for n, p in firsts.items()])
        if row_ids == FEW_SHARED:
            few = pick.chosen_positions(narrow, names.ROW_ID, list(firsts), shared_only=True)
            few = few.withColumn("_is_shared", F.lit(True))
            settled = events.join(few, names.ROW_ID, "left").withColumn(
                "_chosen", F.when(F.col("_is_shared"), F.col("_chosen")).otherwise(own)
            )
        else:
            chosen = pick.chosen_positions(narrow, names.ROW_ID, list(firsts))
            settled = packed.shuffled(
                events,
                {names.DISPLAYED, names.EVENT_COUPONS, *_sources(events, names.OTHER)},
                {names.ROW_ID},
                lambda sent: pick.join_by_key(sent, chosen, names.ROW_ID),
            )
    # The coupons that stay are settled before displayed hotels multiply the event.
    picked = arrays.picked_elements(coupons, F.col("_chosen"), STATUS, keep_unmatched)
    kept = settled.withColumn("_kept", picked)
    return _facts(_open_coupons(_expand_display(kept), F.col("_kept")), names.OTHER)
