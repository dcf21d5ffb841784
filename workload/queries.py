"""Queries over the driver's tables, one per operator of the library.

Nested inputs come from ``workload.nested``. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
)

from lodgetrail.functions import columns, scalars
from lodgetrail.functions.columns import EMPTY, null, rule
from lodgetrail.operators import arrays, combine, enrich, filters, pick, report
from lodgetrail.plans import day_job as job, declared, layout, prepare, steps
from lodgetrail.sources import readers, scratch, writers
from workload import nested, wide

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
DAY = nested.DAY


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


# Projections and scalar functions

DECIMAL_TEXTS = ("%d.0", "%d.7", "-%d.9", " %d ", "%d.", "1e%d", "7%d000.5", "")


@query
def cast_decimal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with decimals to whole numbers: cut at the point, NULL where it is no number or does not fit."""
    lines = nested.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.get(F.array(*[F.format_string(t, "l_partkey") if t else F.lit("") for t in DECIMAL_TEXTS]), (F.col("l_orderkey") % 8).cast("int"))
        .alias("amount"),
    )
    whole = [rule(f"as_{kind}", "amount", kind) for kind in ("smallint", "int", "bigint")]
    return columns.project(lines, [*columns.carry("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "amount"), *whole])


@query
def project_cast_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renames, case changes and casts that turn bad input into NULL."""
    customer = nested.table(spark, sf_dir, "customer").select(
        "*",
        (F.col("c_custkey") * 37).cast("string").alias("key_text"),
        F.format_string("1998-%d-15", "c_nationkey").alias("day_text"),
        F.get(F.array(*[F.lit(t) for t in ("yes", "false", "", "1", "maybe")]), (F.col("c_custkey") % 5).cast("int"))
        .alias("flag_text"),
        F.format_string("%d.25", "c_nationkey").alias("rate_text"),
    )
    rules = [
        rule("customer_id", "c_custkey"),
        rule("segment", "c_mktsegment", "lower"),
        rule("name", "c_name", "upper"),
        rule("key_short", "key_text", "smallint"),
        rule("key_int", "key_text", "int"),
        rule("key_long", "key_text", "bigint"),
        rule("rate", "rate_text", "double"),
        rule("flag", "flag_text", "boolean"),
        rule("flag_long", "flag_text", "bigint"),
        rule("day", "day_text", "date"),
        rule("label", "c_mktsegment", "string"),
        rule("absent", "no_such_column"),
    ]
    return columns.project(customer, rules)


@query
def join_array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.raw_events(spark, sf_dir).select(
        "meta_rq_id",
        scalars.joined(F.col("fltr_star")).alias("stars"),
        scalars.joined(F.col("cpn_resp_ls.cpn_cd")).alias("coupons"),
        scalars.joined(F.col("cpn_resp_ls.cpn_status")).alias("statuses"),
    )


@query
def struct_and_first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.raw_events(spark, sf_dir).select(
        "meta_rq_id",
        F.col("locus.pd_loc_city_cd").alias("city"),
        scalars.first_field(F.col("locus.poi_ls"), "poi_nm").alias("poi_name"),
        scalars.first_field(F.col("locus.poi_ls"), "poi_lat").alias("poi_lat"),
        scalars.first_field(F.col("cpn_resp_ls"), "cpn_cd").alias("first_coupon"),
    )


@query
def step_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose source depends on the step, constants and typed NULLs."""
    events = nested.table(spark, sf_dir, "events").withColumn("step", F.col("event_type"))
    rules = [
        rule("event_id"),
        rule("amount", "value", view=null("double"), click="event_id"),
        rule("who", "user_id", "string", view=EMPTY),
        rule("rank", null("int"), click="user_id", convert="int"),
        rule("note", EMPTY),
    ]
    return columns.project(events, rules, step_column="step").withColumn("meta_row_type", F.lit(0))


@query
def epoch_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return nested.table(spark, sf_dir, "events").select(
        "event_id",
        scalars.epoch_text(millis).alias("ts_text"),
        scalars.epoch_day(millis).alias("day_text"),
        F.lit(DAY).cast("date").alias("event_date"),
    )


@query
def step_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events each step predicate lets through, per step."""
    step = F.col("step")
    events = nested.table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 17 != 0, F.col("event_type")).alias("step"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("id"),
    )
    tests = {
        "on_click": filters.on_step(step, "click"),
        "off_click": filters.off_steps(step, "click"),
        "off_both": filters.off_steps(step, "click", "view"),
        "view_needs_id": filters.needs_on_step(step, "view", F.col("id")),
        "error_or_null": filters.is_or_null(step, "error"),
    }
    # NULL steps fall out of a step test and of its negation alike.
    return events.groupBy(F.coalesce(step, F.lit("none")).alias("step")).agg(
        F.count("*").alias("events"), *[F.count_if(t).alias(name) for name, t in tests.items()]
    )


# Arrays


@query
def explode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = nested.raw_events(spark, sf_dir).select("meta_rq_id", "pd_htl_trff_srvr_ls")
    return arrays.open_array(raw, "pd_htl_trff_srvr_ls", "tariff").select(
        "meta_rq_id", F.col("tariff.pd_htl_rm_cd").alias("room"), F.col("tariff.prc_sell_amt_w_tax").alias("price")
    )


def opened_coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = nested.raw_events(spark, sf_dir).select("meta_rw_id", "meta_rq_id", "cpn_resp_ls")
    opened = arrays.open_array(raw, "cpn_resp_ls", "coupon", position="pos")
    return opened.select("meta_rw_id", "meta_rq_id", "pos", "coupon.cpn_cd", "coupon.cpn_status")


@query
def posexplode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opened_coupons(spark, sf_dir)


@query
def array_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = nested.raw_events(spark, sf_dir)
    pairs = arrays.matched_pairs(F.col("pd_htl_dtl_disp"), F.col("pd_htl_srvr_ls"), "pd_htl_id")
    return raw.select("meta_rq_id", F.explode(pairs).alias("pair")).select(
        "meta_rq_id",
        "pair.position",
        F.col("pair.left.pd_htl_rnk_disp").alias("shown_rank"),
        F.col("pair.right.pd_htl_rank").alias("server_rank"),
    )


# Top-1 and priority picks


def opened_tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = nested.raw_events(spark, sf_dir).select(
        "meta_rw_id", "meta_rq_id", F.col("prc_sell_amt_w_tax").alias("event_price"), "pd_htl_trff_srvr_ls"
    )
    opened = arrays.open_array(raw, "pd_htl_trff_srvr_ls", "tariff", position="pos")
    return opened.select(
        "meta_rw_id",
        "meta_rq_id",
        "event_price",
        "pos",
        F.col("tariff.pd_htl_rm_cd").alias("room"),
        F.col("tariff.prc_sell_amt_w_tax").alias("price"),
        F.col("tariff.pd_htl_lowest_trff").alias("lowest"),
    )


@query
def cheapest_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row id, the tariff of the least weighted price."""
    weight = scalars.price_weight(F.col("lowest"), F.col("event_price"))
    weighted = opened_tariffs(spark, sf_dir).withColumn("weight", weight)
    best = pick.top_one(weighted, ["meta_rw_id"], [F.col("weight"), F.col("pos"), F.col("meta_rq_id")])
    return best.select("meta_rw_id", "meta_rq_id", "pos", "room", "weight")


@query
def cheapest_item_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = opened_tariffs(spark, sf_dir)
    best = pick.top_one(opened, ["meta_rw_id"], [F.col("price"), F.col("pos"), F.col("meta_rq_id")])
    return best.select("meta_rw_id", "meta_rq_id", "pos", "room", "price")


@query
def best_tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tariff chosen inside each event's array, then per row id."""
    prepared = prepare.prepare_events(nested.raw_events(spark, sf_dir)).where(F.col("meta_rw_id").isNotNull())
    return steps.best_tariff(prepared).select(
        "meta_rw_id",
        "meta_rq_id",
        F.col("tariff.pd_htl_rm_cd").alias("room"),
        F.col("tariff.prc_sell_amt_w_tax").alias("price"),
    )


@query
def status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = pick.status_positions(
        opened_coupons(spark, sf_dir), "meta_rw_id", "pos", "cpn_status", layout.OTHER_PRIORITIES
    )
    chosen = F.coalesce(*[F.col(s) for s in layout.OTHER_PRIORITIES])
    return positions.withColumn("chosen", chosen).withColumnsRenamed(
        {"BEST_COUPON": "best", "REDEEMED": "redeemed", "OTHER_COUPON": "other"}
    )


@query
def priority_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = opened_coupons(spark, sf_dir)
    return pick.priority_pick(opened, "meta_rw_id", "pos", "cpn_status", layout.DETAIL_PRIORITIES)


@query
def priority_pick_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = opened_coupons(spark, sf_dir)
    return pick.priority_pick(opened, "meta_rw_id", "pos", "cpn_status", layout.OTHER_PRIORITIES)


@query
def priority_pick_keep_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = opened_coupons(spark, sf_dir)
    return pick.priority_pick(
        opened, "meta_rw_id", "pos", "cpn_status", layout.DETAIL_PRIORITIES, keep_unmatched=True
    )


@query
def recommended_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered inside the array, then opened."""
    raw = nested.raw_events(spark, sf_dir)
    kept = arrays.kept_elements(
        F.col("cpn_resp_ls"), lambda c, _: filters.is_or_null(c.getField("cpn_status"), "RECOMMEND")
    )
    return raw.select("meta_rq_id", F.explode(kept).alias("coupon")).select(
        "meta_rq_id", "coupon.cpn_cd", "coupon.cpn_status"
    )


@query
def shared_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pick.shared_keys(nested.raw_events(spark, sf_dir), "meta_rw_id")


# Joins, aggregates, schemas, sinks


@query
def dim_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation, with a nation dimension keyed by text."""
    nation = nested.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("hotel_id"), F.lower("n_name").alias("city_code")
    )
    cities = prepare.hotel_cities(nation.where(F.col("hotel_id") != "3").unionAll(nation))
    facts = nested.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey")).alias("nation")
    )
    return enrich.attach(facts, cities, "nation", prepare.HOTEL_KEY)


@query
def ambiguous_hotels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.ambiguous_keys(prepare.hotel_cities(nested.hotels(spark, sf_dir)), prepare.HOTEL_KEY)


@query
def name_and_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = nested.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("first_name"),
        F.when(F.col("p_size") != 7, F.col("p_type")).alias("second_name"),
        F.col("p_size").cast("bigint").alias("floor"),
    )
    return report.desk_report(people, 21)


@query
def mean_and_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rows_and_mean(nested.table(spark, sf_dir, "lineitem"), "l_quantity")


@query
def schema_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = nested.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat("user_id", F.when(F.col("user_id") % 4 == 0, "x").otherwise("")).alias("user_id"),
        (F.col("event_id") * 11).cast("string").alias("small"),
        "event_type",
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("day"),
        F.when(F.col("event_id") % 2 == 0, "true").otherwise("false").alias("even"),
        F.concat("user_id", F.lit(".5")).alias("half"),
    )
    schema = StructType(
        [
            StructField("even", BooleanType()),
            StructField("event_id", LongType()),
            StructField("user_id", IntegerType()),
            StructField("small", ShortType()),
            StructField("half", DoubleType()),
            StructField("day", DateType()),
            StructField("not_there", StringType()),
        ]
    )
    return combine.enforce_schema(events, schema)


@query
def branch_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches with different columns put together by name."""
    events = nested.table(spark, sf_dir, "events")
    step = F.col("event_type")
    detail = events.where(filters.on_step(step, "click")).drop("props", "ts")
    listing = events.where(filters.on_step(step, "view")).select("event_id", "event_type", F.col("user_id").alias("seen_by"))
    others = events.where(filters.off_steps(step, "click", "view")).select("*", F.upper(step).alias("kind")).drop("props", "ts")
    return combine.union_branches(detail, listing, others)


@query
def csv_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension written as delimited text and read back by column name."""
    path = scratch.fresh_path(spark, "csv-dim")
    writers.write_delimited(nested.table(spark, sf_dir, "customer"), path, separator="|")
    return readers.read_delimited(spark, path, ["c_mktsegment", "c_custkey", "c_name"])


@query
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "table")
    writers.write_table(nested.table(spark, sf_dir, "orders"), path)
    return readers.read_table(spark, path).select("o_orderkey", "o_custkey", "o_orderpriority")


# The funnel

CHECKED = """
hotel_id profile_type pd_htl_id pd_htl_id_htdsp meta_fnnl_step correlation_key record_pdt_ts record_client_ts
browsing_date meta_row_id time_spent ap checkin_date is_multi_room is_free_cncl is_htl_sold_out filter_star_arr
pd_htl_rnk_disp htl_rnk_disp_order disp_sell_amt room_code prc_sell_amt_w_tax srvr_hotel_rank hotel_searched
cpn_cd cpn_amt cpn_status cpn_dis_types_arr loc_city_code loc_region_codes_arr loc_region_codes_arr_srvr
loc_location_id loc_poi_name loc_poi_lat
""".split()
FINISHED = [*CHECKED, "meta_row_type", "mmt_hotel_id", "city_code", "htl_city_code", "event_date"]


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_events(nested.raw_events(spark, sf_dir))


@query
def prepared_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).select(
        "meta_rq_id", "meta_fnnl_step", "record_processed_ts", "record_pdt_ts", "record_client_ts", "browsing_date",
        "filter_star_arr", "bkg_chld_id_arr", "room_code", "domain_sbu", "pd_loc_city_cd", "location_id", "poi_nm", "poi_lat",
    )


@query
def display_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.display_expanded(prepared(spark, sf_dir)).select(
        "meta_rq_id", "meta_fnnl_step", "pos", F.col("shown.pd_htl_id").alias("shown_id"), "shown.pd_htl_rnk_disp"
    )


@query
def detail_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.detail_facts(prepared(spark, sf_dir)).select(*CHECKED)


@query
def detail_step_event_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.detail_facts(prepared(spark, sf_dir), steps.EVENT_PRICE_ORDER).select(*CHECKED)


@query
def detail_step_keep_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.detail_facts(prepared(spark, sf_dir), keep_unmatched=True).select(*CHECKED)


@query
def listing_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.listing_facts(prepared(spark, sf_dir)).select(*CHECKED)


@query
def listing_step_all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.listing_facts(prepared(spark, sf_dir), listing_only=False).select(*CHECKED)


@query
def other_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.other_facts(prepared(spark, sf_dir)).select(*CHECKED)


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hotel dimension as ``run_day`` attaches it: facts are not shuffled for one that measures small enough."""
    hotels = prepare.hotel_cities(nested.hotels(spark, sf_dir)).drop(prepare.CITY)
    return enrich.broadcast_if_small(hotels, job.BROADCAST_HOTELS)


@query
def day_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    hotels = cities(spark, sf_dir)
    return job.day_facts(nested.raw_events(spark, sf_dir), hotels, DAY).select(*FINISHED)


@query
def day_job_older_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    hotels = cities(spark, sf_dir)
    raw = nested.older(nested.raw_events(spark, sf_dir))
    return job.day_facts(raw, hotels, DAY).select(*FINISHED)


@query
def day_job_unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with a row id of its own: one pass over the events for all steps."""
    hotels = cities(spark, sf_dir)
    raw = nested.raw_events(spark, sf_dir)
    own = F.when(F.col("meta_rw_id").isNotNull(), F.col("meta_rq_id"))
    facts = job.day_facts(raw.withColumn("meta_rw_id", own), hotels, DAY, steps.UNIQUE, steps.UNIQUE)
    return facts.select(*FINISHED)


@query
def day_job_reference_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tariffs by the event's price, and the other steps' events in the listing branch too."""
    hotels = cities(spark, sf_dir)
    raw = nested.raw_events(spark, sf_dir)
    facts = job.day_facts(raw, hotels, DAY, tariff_order=steps.EVENT_PRICE_ORDER, listing_only=False)
    return facts.select(*FINISHED)


def mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """Events of a day whose files hold both layouts: suppliers with odd keys write the older one."""
    events = f"{scratch.fresh_path(spark, 'mixed')}/events"
    raw = nested.raw_events(spark, sf_dir)
    odd = F.substring_index("meta_rq_id", "-", -1).cast("bigint") % 2 == 1
    nested.older(raw.where(odd)).write.parquet(f"{events}/date_part={DAY}")
    raw.where(~odd).write.mode("append").parquet(f"{events}/date_part={DAY}")
    return events


@query
def day_layout_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of both layouts, each row in its file's layout, held to the declared schema."""
    flag = (layout.LOCATION, layout.OLDER)
    day = readers.read_events(spark, mixed_files(spark, sf_dir), DAY, layout.raw_paths(), flag_lacking=flag)
    hotels = cities(spark, sf_dir)
    return job.day_facts(day, hotels, DAY, schema=declared.FACT_SCHEMA).select(*FINISHED)


@query
def day_mixed_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same day read without telling its files apart."""
    events = mixed_files(spark, sf_dir)
    day = readers.read_events(spark, events, DAY, layout.raw_paths())
    return job.day_facts(day, cities(spark, sf_dir), DAY).select(*FINISHED)


def prepared_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_events(wide.raw_events(spark, sf_dir))


@query
def detail_step_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 184 columns, from events that hold every raw column."""
    return steps.detail_facts(prepared_wide(spark, sf_dir))


@query
def listing_step_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.listing_facts(prepared_wide(spark, sf_dir))


@query
def other_steps_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.other_facts(prepared_wide(spark, sf_dir))


@query
def day_job_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 189 columns of the day's facts."""
    hotels = cities(spark, sf_dir)
    return job.day_facts(wide.raw_events(spark, sf_dir), hotels, DAY)


def day_files(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Events and hotels written as the job's input, and where facts may go."""
    base = scratch.fresh_path(spark, "day")
    events, hotels = f"{base}/events", f"{base}/hotels"
    nested.raw_events(spark, sf_dir).write.parquet(f"{events}/date_part={DAY}")
    writers.write_delimited(nested.hotels(spark, sf_dir), hotels, separator="|")
    return events, hotels, f"{base}/facts"


@query
def fact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole day job from files to files: events and hotels written, facts read back."""
    events, hotels, out = day_files(spark, sf_dir)
    path = job.run_day(spark, events, hotels, DAY, out)
    facts = spark.read.parquet(path).withColumn("browsing_date", F.col("browsing_date").cast("string"))
    return facts.select(*FINISHED)
