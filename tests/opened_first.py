"""The steps in their plain form: open every array first, then rank, pivot and join.

Slower than the library's steps, which choose inside the arrays; here to check
their results against, and to time them against.
"""

from pyspark.sql import Window, functions as F

from lodgetrail.functions import columns
from lodgetrail.plans import layout


def _pick(facts, statuses):
    """``facts`` carry the coupon position: keep the preferred coupon's rows by pivot and join."""
    pivot = facts.groupBy("meta_row_id").pivot("cpn_status", list(statuses)).agg(F.min("coupon_pos"))
    chosen = pivot.select(F.col("meta_row_id").alias("id_x"), F.coalesce(*statuses).alias("chosen"))
    joined = facts.join(chosen, F.col("meta_row_id") == F.col("id_x"))
    kept = joined.where((F.col("coupon_pos") == F.col("chosen")) | F.col("cpn_status").isNull())
    return kept.drop("id_x", "chosen", "coupon_pos")


def _with_position(opened, step):
    rules = [*layout.fact_columns(True), columns.rule("coupon_pos")]
    return columns.project(opened, rules, step)


def detail(prepared):
    events = prepared.where("meta_fnnl_step = 'detail'")
    opened = events.select("*", F.posexplode_outer("pd_htl_trff_srvr_ls").alias("tariff_pos", "tariff"))
    best = Window.partitionBy("meta_rw_id").orderBy(
        ~F.coalesce("tariff.pd_htl_lowest_trff", F.lit(False)),
        F.col("tariff.prc_sell_amt_w_tax").isNull(),
        "tariff.prc_sell_amt_w_tax",
        F.col("tariff_pos").asc_nulls_last(),
        "record_pdt_ts",
        "meta_rq_id",
    )
    won = opened.withColumn("rank", F.row_number().over(best)).where("rank = 1")
    coupons = won.select("*", F.posexplode_outer("tariff.cpn_resp_trff_ls").alias("coupon_pos", "coupon"))
    return _pick(_with_position(coupons, "detail"), layout.DETAIL_PRIORITIES)


def others(prepared):
    events = prepared.where("meta_fnnl_step NOT IN ('detail', 'listing')")
    shown = events.select("*", F.posexplode_outer("pd_htl_dtl_disp").alias("pos", "shown"))
    coupons = shown.select("*", F.posexplode_outer("cpn_resp_ls").alias("coupon_pos", "coupon"))
    return _pick(_with_position(coupons, "other"), layout.OTHER_PRIORITIES)


def listing(prepared):
    events = prepared.where("meta_fnnl_step = 'listing'")
    shown = events.select("*", F.posexplode_outer("pd_htl_dtl_disp").alias("pos", "shown"))
    matched = shown.select("*", F.explode_outer("pd_htl_srvr_ls").alias("server")).where(
        "server.pd_htl_id = shown.pd_htl_id"
    )
    coupons = matched.select("*", F.explode_outer("server.cpn_resp_htl_ls").alias("coupon"))
    kept = coupons.where("coupon.cpn_status = 'RECOMMEND' OR coupon.cpn_status IS NULL")
    return columns.project(kept, layout.fact_columns(True), "listing")
