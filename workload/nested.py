"""Nested funnel events made of the flat tables, row by row.

Each lineitem becomes one raw event whose arrays are computed from its own
columns, so the work grows with the table, no group is ever collected and no
shuffle is needed. Order keys serve as row ids: several events share one.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

DAY = "2020-09-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A row becomes an event of many times its size: so many at most are one task's.
EVENTS_A_TASK = 100_000


def spread(df: DataFrame) -> DataFrame:
    """Dealt out so that a task makes few enough events to sort them in memory.

    A split of narrow rows holds millions of them, where one of stored events
    would hold thousands. Inputs of few rows go over all cores. Rows are dealt
    by a hash of all their columns, which brings no key together.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-df.count() // EVENTS_A_TASK))
    return df.repartition(tasks, F.xxhash64(*df.columns)) if df.rdd.getNumPartitions() < tasks else df


def listed(n: str, position: str, element: str) -> str:
    """An array of ``n`` elements, up to four, made from their positions.

    Spark compiles these, where it would interpret a lambda. Elements beyond
    ``n`` are not worked out; a NULL or negative ``n`` gives an empty array.
    """
    each = [f"CASE WHEN {n} > {i} THEN {re.sub(rf'\b{position}\b', str(i), element)} END" for i in range(4)]
    return f"slice(array({', '.join(each)}), 1, greatest(CAST({n} AS INT), 0))"


def coupon(code: str, kind: str) -> str:
    """A coupon at position j, its status by ``kind``."""
    status = f"get(array('BEST_COUPON', 'OTHER_COUPON', 'RECOMMEND', NULL, 'REDEEMED'), CAST(({kind}) % 5 AS INT))"
    amount = "CASE WHEN (p + j) % 6 = 0 THEN '' ELSE CAST((p + j) % 90 AS STRING) END"
    types = "CASE WHEN j % 2 = 0 THEN array('a', NULL, concat('b', j)) END"
    return f"struct({code} AS cpn_cd, {status} AS cpn_status, {amount} AS cpn_amt, {types} AS cpn_dis_types)"


TARIFF_COUPONS = listed("(s + i) % 4", "j", coupon("concat('t', p + 10 * i + j)", "p + i + j"))
TARIFF = f"""struct(
  concat('room-', p * 10 + i) AS pd_htl_rm_cd,
  CASE WHEN (p + i) % 11 <> 0 THEN price + ((s + 7 * i) % 5) * 10 END AS prc_sell_amt_w_tax,
  (s + i) % 3 = 0 AS pd_htl_lowest_trff,
  {TARIFF_COUPONS} AS cpn_resp_trff_ls)"""

DISPLAYED = """struct(
  CASE WHEN (p + d) % 13 <> 0 THEN CAST(p + d AS STRING) END AS pd_htl_id,
  2 * d + 1 AS pd_htl_rnk_disp,
  CASE WHEN (p + d) % 7 = 0 THEN 'n/a' ELSE concat(p + d, '.5') END AS pd_disp_sell_amt)"""

SERVER_COUPONS = listed("(p + k) % 3", "j", coupon("concat('h', p + k + j)", "p + k + j"))
SERVER = f"""struct(
  CAST(p + k % 3 AS STRING) AS pd_htl_id,
  CAST(k + 1 AS STRING) AS pd_htl_rank,
  price + k AS prc_sell_amt_w_tax,
  k % 2 = 0 AS pd_htl_fc,
  {SERVER_COUPONS} AS cpn_resp_htl_ls,
  struct(concat('L', p + k) AS location_id, array('x', concat('y', k)) AS pd_srvr_loc_reg_cds) AS locus_hotel)"""

LOCATION = f"""struct(
  concat('C', s % 7) AS pd_loc_city_cd,
  array('r1', NULL, concat('r', s % 3)) AS pd_loc_reg_cds,
  concat('E', p) AS location_id,
  {listed("p % 2", "i", "struct(concat('poi', p) AS poi_nm, p / CAST(10 AS DOUBLE) AS poi_lat)")} AS poi_ls)"""

STEP = """CASE WHEN q = 50 THEN NULL WHEN l_returnflag = 'R' THEN 'detail' WHEN l_returnflag = 'A' THEN 'listing'
  WHEN l_linestatus = 'O' THEN 'Review' ELSE 'thankyou' END"""

# A lambda keeps Spark from making one method of all columns, which would be too long for the JVM to compile.
STARS = "transform(array(l_returnflag, NULL, l_linestatus), flag -> flag)"

# Events of the run's day, some of them up to two days late.
MILLIS = f"""unix_millis(TIMESTAMP '{DAY}') + ((p * 1009 + s * 31) % 86400) * 1000 + 123 - (ln % 3) * 86400000"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events in the current layout; columns without a counterpart are left out."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_returnflag", "l_linestatus", "CAST(l_shipdate AS DATE) AS shipped",
        "l_partkey AS p", "l_suppkey AS s", "l_linenumber AS ln", "l_extendedprice AS price", "CAST(l_quantity AS INT) AS q",
    )
    return spread(lines).selectExpr(
        "CASE WHEN ln <> 7 OR p % 50 <> 0 THEN CAST(l_orderkey AS STRING) END AS meta_rw_id",
        f"{STEP} AS meta_fnnl_step",
        "concat_ws('-', l_orderkey, ln, p, s) AS meta_rq_id",
        "CASE WHEN s % 20 <> 0 THEN CAST(p AS STRING) END AS pd_htl_id",
        "concat('kind-', lower(l_linestatus)) AS usr_prof_typ",
        "CASE WHEN q % 10 = 0 THEN '' ELSE CAST(q * 1000 AS STRING) END AS srch_ap",
        "CAST(shipped AS STRING) AS srch_checkin_dt",
        "CAST(p * 1000 AS STRING) AS meta_pg_tm_intvl",
        "get(array('yes', 'no', 'maybe'), ln % 3) AS bkg_mlt_rm",
        f"{MILLIS} AS m124",
        f"{MILLIS} + 86400000 AS m123",
        f"{MILLIS} AS meta_prcssr_ts",
        "price AS prc_sell_amt_w_tax",
        "s % 2 = 0 AS pd_htl_fc",
        "s % 3 = 0 AS pd_htl_sold_out",
        f"CASE WHEN ln <> 3 THEN {STARS} END AS fltr_star",
        f"CASE WHEN ln <> 6 THEN {listed('ln % 4', 'i', TARIFF)} END AS pd_htl_trff_srvr_ls",
        f"CASE WHEN ln <> 5 THEN {listed('s % 4', 'd', DISPLAYED)} END AS pd_htl_dtl_disp",
        f"{listed('q % 5', 'k', SERVER)} AS pd_htl_srvr_ls",
        f"""CASE WHEN ln <> 2 THEN {listed('p % 4', 'j', coupon("concat('e', p + j)", "p + 3 * j"))} END AS cpn_resp_ls""",
        f"{LOCATION} AS locus",
    )


def older(raw: DataFrame) -> DataFrame:
    """The same events in the older layout, without the location struct."""
    return raw.drop("locus")


def hotels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotel dimension rows made of parts; every tenth hotel has two cities, some rows repeat."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string").alias("hotel_id")
    first = part.select(key, F.lower("p_brand").alias("city_code"))
    second = part.where(F.col("p_partkey") % 10 == 0).select(key, F.lower("p_type").alias("city_code"))
    return first.unionAll(second).unionAll(second)
