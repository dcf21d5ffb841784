"""Hand-written raw events in the documented nested schema."""

COUPON = "struct<cpn_cd:string,cpn_status:string,cpn_amt:string,cpn_dis_types:array<string>>"
TARIFF = f"struct<pd_htl_rm_cd:string,prc_sell_amt_w_tax:double,pd_htl_lowest_trff:boolean,cpn_resp_trff_ls:array<{COUPON}>>"
SERVER = (
    f"struct<pd_htl_id:string,pd_htl_rank:string,prc_sell_amt_w_tax:double,cpn_resp_htl_ls:array<{COUPON}>,"
    "locus_hotel:struct<location_id:string,pd_srvr_loc_reg_cds:array<string>>>"
)
DISPLAYED = "struct<pd_htl_id:string,pd_htl_rnk_disp:int,pd_disp_sell_amt:string>"
LOCATION = (
    "struct<pd_loc_city_cd:string,pd_loc_reg_cds:array<string>,location_id:string,"
    "poi_ls:array<struct<poi_nm:string,poi_lat:double>>>"
)
COLUMNS = {
    "meta_rw_id": "string",
    "meta_fnnl_step": "string",
    "meta_rq_id": "string",
    "pd_htl_id": "string",
    "usr_prof_typ": "string",
    "srch_ap": "string",
    "m123": "bigint",
    "m124": "bigint",
    "meta_prcssr_ts": "bigint",
    "prc_sell_amt_w_tax": "double",
    "pd_htl_fc": "boolean",
    "pd_htl_sold_out": "boolean",
    "fltr_star": "array<string>",
    "pd_htl_trff_srvr_ls": f"array<{TARIFF}>",
    "pd_htl_srvr_ls": f"array<{SERVER}>",
    "pd_htl_dtl_disp": f"array<{DISPLAYED}>",
    "cpn_resp_ls": f"array<{COUPON}>",
    "locus": LOCATION,
}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())

# 2020-12-30 00:00:00.123 UTC, in a week that belongs to the next week-year.
MILLIS = 1609286400123


def coupon(code, status=None, amount="1", types=None):
    return (code, status, amount, types)


def tariff(room, price=None, lowest=None, coupons=None):
    return (room, price, lowest, coupons)


def server(hotel, rank="1", price=None, coupons=None, location=None):
    return (hotel, rank, price, coupons, location)


def event(row_id, step, **values):
    defaults = {"meta_rw_id": row_id, "meta_fnnl_step": step, "m123": MILLIS, "m124": MILLIS, "meta_prcssr_ts": MILLIS}
    return tuple({**dict.fromkeys(COLUMNS), **defaults, **values}[c] for c in COLUMNS)


def frame(spark, *events):
    return spark.createDataFrame(list(events), SCHEMA)
