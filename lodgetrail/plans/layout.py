"""The funnel's columns: what the raw events hold and what the facts are made of.

Paths name top-level event columns, or fields of the element a step opened:
``shown`` (a displayed hotel), ``server`` (its server-side twin), ``tariff``
(the chosen tariff) and ``coupon``. On steps where an element was not opened
its fields read as NULL.
"""

from __future__ import annotations

from dataclasses import replace

from lodgetrail.functions.columns import EMPTY, Rule, carry, null, paths, rule

DETAIL = "detail"
LISTING = "listing"
OTHER = "other"

ROW_ID = "meta_rw_id"
STEP = "meta_fnnl_step"

TARIFFS = "pd_htl_trff_srvr_ls"
DISPLAYED = "pd_htl_dtl_disp"
SERVER_HOTELS = "pd_htl_srvr_ls"
EVENT_COUPONS = "cpn_resp_ls"
TARIFF_COUPONS = "cpn_resp_trff_ls"
SERVER_COUPONS = "cpn_resp_htl_ls"
LOCATION = "locus"
# Flags events of a file in the older layout, where a day holds both.
OLDER = "older_layout"

DETAIL_PRIORITIES = ("BEST_COUPON", "OTHER_COUPON")
OTHER_PRIORITIES = ("BEST_COUPON", "REDEEMED", "OTHER_COUPON")
LISTING_STATUS = "RECOMMEND"

# Names of the event columns that pass through preparation unchanged.
CARRIED = """
usr_uuid usr_prof_typ dvc_did pd_htl_id usr_mcid
meta_rq_id meta_rw_id meta_rw_id_srvr meta_rw_id_clnt meta_act_cntnt meta_fnnl_step meta_usr_agnt meta_timezone
meta_pg_nm_full meta_pg_nm meta_lob_nm meta_act_nm meta_pg_tm_intvl meta_cmpny_id meta_clnt_ip meta_env
srch_trvl_purp_optd srch_ap srch_rsq srch_rm_tot srch_los srch_guest_adult srch_rm_nghts srch_trvl_purp
srch_guest_tot srch_typ srch_checkin_dt srch_checkout_dt srch_sty_area srch_sty_cty srch_sty_city srch_guest_child
prc_surge_prcnt dvc_type dvc_os prc_wal_bal bkg_mlt_rm pd_htl_cty
exp_id exp_rnk_ordr exp_pol_ver exp_pol_id pd_htl_fc pd_htl_pah usr_omni_vid sess_mmt_id sess_vst_no
fltr_price fltr_clr_all srt_ordr srt_by dvc_g_city dvc_os_ver dvc_app_ver cpn_code bkg_txn_id prc_amt_chrgd
usr_wal_bns_bal usr_wal_plus_bal usr_wal_real_bal prc_surge_applcbl_on pd_htl_city_sold_out pd_htl_sold_out
exp_disp_prc exp_disp_prc_multiplier prc_disp_amt_wo_dis_srvr prc_disp_amt_w_dis_srvr exp_disp_prc_tax_included
exp_city_tax_included prc_mkp_amt prc_commission prc_profit prc_htl_base_prc prc_hot_disc pd_htl_rm_nm pd_htl_rm_typ
prc_aaj_ka_bhao_flg prc_absrpn_amt prc_extrapax_amt prc_mkpsrv_fee prc_pay_mod prc_sell_amt_w_tax prc_sell_amt_wo_tax
prc_div_fac usr_intnd_scr pd_supplr_cd pd_htl_srvr_ls pd_htl_trff_srvr_ls pd_htl_dtl_disp prc_tax_htl prc_wal_amt
cpn_resp_ls
""".split()

# Array columns and the text columns their joined elements go to.
JOINED = (
    ("bkg_chld_id_arr", "bkg_chld_id"),
    ("filter_htl_img_tag_clckd_arr", "fltr_htl_img_tag_clckd"),
    ("filter_prop_type_arr", "fltr_prop_typ"),
    ("filter_star_arr", "fltr_star"),
    ("filter_loc_arr", "fltr_loc"),
    ("filter_amenities_arr", "fltr_aminities"),
    ("filter_applied_arr", "fltr_appld"),
    ("filter_removed_arr", "fltr_rmvd"),
    ("filter_htl_rvw_appld_arr", "fltr_htl_rvw_appld"),
    ("filter_htl_rm_slctns_arr", "fltr_htl_rm_slctns"),
    ("filter_usr_rating_arr", "fltr_usr_rating"),
)

# Columns only the current layout has, under their prepared names.
CURRENT_ONLY = [
    *carry("domain_sbu", "domain_country", "domain_currency", "domain_language"),
    *carry("funnel_source", "property_type"),
    rule("user_source_city", "usr_src_city"),
    rule("user_source_country", "usr_src_country"),
    rule("retry_count"),
    rule("hotels_received_count", "no_hotels_recv"),
    rule("hotels_requested_count", "no_hotels_req"),
    rule("amenity_count", "pd_amenity_count"),
    rule("image_count", "pd_image_count"),
    rule("room_level_review_count", "pd_room_level_review_count"),
    rule("supplier_code", "pd_supplier_code"),
    rule("supplier_room_code", "pd_supplier_room_code"),
]

# Prepared columns computed in both layouts.
DERIVED = [
    rule("pd_disp_sell_amt_dis_main", "pd_disp_sell_amt_dis", "double"),
    rule("pd_disp_sell_amt_main", "pd_disp_sell_amt", "double"),
    *[rule(target, source, "join") for target, source in JOINED],
    rule("record_processed_ts", "meta_prcssr_ts", "timestamp_text"),
    rule("record_pdt_ts", "m124", "timestamp_text"),
    rule("record_client_ts", "m123", "timestamp_text"),
    rule("browsing_date", "m124", "day_text"),
    rule("room_code", EMPTY),
    rule("pd_htl_rm_cd", EMPTY),
    rule("pd_htl_rt_plan_cd", EMPTY),
]

# Fields of the location struct that become prepared columns.
LOCATION_FIELDS = """
pd_loc_st_code pd_loc_city_cd pd_loc_reg_cds pd_loc_ctry_cd pd_is_locus
pd_srvr_loc_st_cd pd_srvr_loc_city_cd pd_srvr_loc_reg_cds pd_loc_area_cds pd_srvr_loc_ctry_cd
location_id location_type
""".split()
POI_FIELDS = "poi_nm poi_cd poi_lat poi_long poi_type".split()


def prepared_columns(has_location: bool) -> list[Rule]:
    """Columns of the prepared events, for the current or the older input layout."""
    common = [*carry(*CARRIED), *DERIVED]
    if not has_location:
        return [*common, *[rule(c, EMPTY) for c in ("srch_typ_loc", "srch_txt", LOCATION)]]
    return [
        *common,
        *carry("srch_typ_loc", "srch_txt", LOCATION),
        *CURRENT_ONLY,
        *[rule(f, f"{LOCATION}.{f}") for f in LOCATION_FIELDS],
        *[rule(f, f"{LOCATION}.poi_ls.{f}", "first") for f in POI_FIELDS],
    ]


# The output's common columns, in output order.
COMMON = [
    rule("hotel_id", "pd_htl_id", listing="shown.pd_htl_id"),
    rule("uuid", "usr_uuid"),
    rule("profile_type", "usr_prof_typ", "upper"),
    rule("device_id", "dvc_did"),
    rule("user_mcid", "usr_mcid"),
    rule("pd_htl_id"),
    rule("pd_htl_id_htdsp", "shown.pd_htl_id", detail=EMPTY),
    rule("meta_fnnl_step", "meta_fnnl_step", "lower"),
    rule("visitor_id", "usr_omni_vid"),
    rule("correlation_key", "meta_rq_id"),
    *carry("record_processed_ts", "record_pdt_ts", "record_client_ts", "browsing_date"),
    rule("meta_row_id", "meta_rw_id"),
    rule("meta_row_id_srvr", "meta_rw_id_srvr"),
    rule("meta_row_id_clnt", "meta_rw_id_clnt"),
    rule("meta_act_cntnt"),
    rule("meta_user_agent", "meta_usr_agnt"),
    rule("meta_timezone"),
    rule("page_name", "meta_pg_nm_full"),
    rule("pg_nm_omniture", "meta_pg_nm"),
    rule("lob_name", "meta_lob_nm"),
    rule("meta_activity_name", "meta_act_nm", "lower"),
    rule("time_spent", "meta_pg_tm_intvl", "bigint"),
    rule("company_id", "meta_cmpny_id"),
    rule("client_ip", "meta_clnt_ip"),
    rule("env", "meta_env"),
    rule("query_travel_purpose_optd", "srch_trvl_purp_optd", "boolean"),
    rule("ap", "srch_ap", "smallint"),
    rule("roomstayqualifier", "srch_rsq"),
    rule("total_rooms", "srch_rm_tot", "smallint"),
    rule("length_of_stay", "srch_los", "smallint"),
    rule("total_adults", "srch_guest_adult", "smallint"),
    rule("total_room_nights", "srch_rm_nghts", "smallint"),
    rule("travel_purpose", "srch_trvl_purp"),
    rule("total_guests", "srch_guest_tot", "smallint"),
    rule("query_type", "srch_typ"),
    rule("checkin_date", "srch_checkin_dt", "date"),
    rule("checkout_date", "srch_checkout_dt", "date"),
    rule("query_value", "srch_sty_area"),
    rule("query_country", "srch_sty_cty"),
    rule("query_city", "srch_sty_city"),
    rule("total_children", "srch_guest_child", "smallint"),
    rule("policy_version", "exp_pol_ver", listing="server.exp_pol_ver"),
    rule("policy_id", "exp_pol_id", listing="server.exp_pol_id"),
    rule("prc_surge_prcnt", listing="server.prc_surge_prcnt"),
    rule("device_type", "dvc_type"),
    rule("os", "dvc_os", "upper"),
    rule("prc_wallet_balance", "prc_wal_bal", "double"),
    rule("is_multi_room", "bkg_mlt_rm", "boolean"),
    rule("country_code", "pd_htl_cty", listing="server.pd_htl_cty"),
    rule("exp_id"),
    rule("exp_rnk_algo_ver", "exp_rnk_ordr"),
    rule("exp_pol_ver", listing="server.exp_pol_ver"),
    rule("exp_pol_id", listing="server.exp_pol_id"),
    # Always NULL on detail rows, which have no displayed hotel to read it from.
    rule("is_free_cncl", "pd_htl_fc", listing="server.pd_htl_fc", detail=null("boolean")),
    rule("is_pah", "pd_htl_pah", "boolean"),
    rule("usr_wal_bonus_bal", "usr_wal_bns_bal", "double"),
    rule("usr_wal_plus_bal", "usr_wal_plus_bal", "double"),
    rule("usr_wal_real_bal", "usr_wal_real_bal", "double"),
    rule("usr_intnd_scr"),
    rule("session_id", "sess_mmt_id"),
    rule("session_vst_num", "sess_vst_no"),
    rule("filter_price", "fltr_price"),
    rule("filter_clr_all", "fltr_clr_all", "boolean"),
    rule("applied_sort", "srt_by"),
    rule("applied_sort_order", "srt_ordr"),
    rule("dvc_g_city"),
    rule("os_version", "dvc_os_ver"),
    rule("app_version", "dvc_app_ver"),
    rule("cpn_code_main", "cpn_code"),
    rule("bkg_txn_id"),
    *carry(*[target for target, _ in JOINED]),
    rule("pd_htl_rnk_disp", "shown.pd_htl_rnk_disp", "int"),
    rule("is_htl_sold_out_lstng", "shown.pd_htl_sold_out", "boolean"),
    rule("is_htl_shrtlstd_lstng", "shown.pd_htl_shrtlstd", "boolean"),
    rule("is_htl_pah_lstng", "shown.pd_htl_pah", "boolean"),
    rule("prc_surge_applcbl_on", listing="server.prc_surge_applcbl_on"),
    rule("is_htl_fc_lstng", "shown.pd_htl_fc", "boolean"),
    rule("is_htl_mmt_assrd_lstng", "shown.pd_htl_mmt_assrd", "boolean"),
    rule("htl_loc_mtch_prcnt_lstng", "shown.pd_htl_loc_mtch_prcnt", "double"),
    rule("htl_rating_disp_lstng", "shown.pd_htl_rt_disp", "double"),
    rule("prc_amt_chrgd", "prc_amt_chrgd", "double"),
    rule("htl_rnk_disp_order", "pos", "int"),
    rule("disp_sell_amt", "pd_disp_sell_amt_main", "double", listing="shown.pd_disp_sell_amt"),
    rule("disp_sell_amt_dis", "pd_disp_sell_amt_dis_main", "double", listing="shown.pd_disp_sell_amt_dis"),
    rule("is_htl_city_sold_out", "pd_htl_city_sold_out"),
    # Always NULL on detail rows, like is_free_cncl.
    rule("is_htl_sold_out", "pd_htl_sold_out", listing="server.pd_htl_sold_out", detail=null("boolean")),
    rule("loc_search_type", "srch_typ_loc"),
    rule("loc_search_text", "srch_txt"),
    *carry(*[spec.target for spec in CURRENT_ONLY]),
]

# Price and room columns, in output order, and the field they come
# from. The field is the chosen tariff's on detail rows, the server hotel's on
# listing rows and the event's own on all others, save for the exceptions below.
PRICE_FIELDS = (
    ("room_code", "pd_htl_rm_cd"),
    ("room_name", "pd_htl_rm_nm"),
    ("room_type", "pd_htl_rm_typ"),
    ("prc_tax_htl", "prc_tax_htl"),
    ("htl_meal_plan_code", "pd_htl_meal_plan"),
    ("htl_rate_plan_code", "pd_htl_rt_plan_cd"),
    ("prc_mkpsrv_fee", "prc_mkpsrv_fee"),
    ("prc_pay_mod", "prc_pay_mod"),
    ("prc_div_fac", "prc_div_fac"),
    ("prc_extrapax_amt", "prc_extrapax_amt"),
    ("prc_hotelier_promotion", "prc_hot_disc"),
    ("prc_mmt_markup", "prc_mkp_amt"),
    ("prc_htl_base_prc", "prc_htl_base_prc"),
    ("prc_sell_amt_wo_tax", "prc_sell_amt_wo_tax"),
    ("prc_absrpn_amt", "prc_absrpn_amt"),
    ("prc_sell_amt_w_tax", "prc_sell_amt_w_tax"),
    ("prc_wal_amt", "prc_wal_amt"),
    ("prc_aaj_ka_bhao_flg", "prc_aaj_ka_bhao_flg"),
    ("prc_commission", "prc_commission"),
    ("prc_profit", "prc_profit"),
    ("exp_city_tax_included", "exp_city_tax_included"),
    ("exp_disp_prc_tax_included", "exp_disp_prc_tax_included"),
    ("exp_disp_prc_multiplier", "exp_disp_prc_multiplier"),
    ("prc_disp_amt_w_dis_srvr", "prc_disp_amt_w_dis_srvr"),
    ("prc_disp_amt_wo_dis_srvr", "prc_disp_amt_wo_dis_srvr"),
    ("exp_disp_prc", "exp_disp_prc"),
    ("pd_supplier_code", "pd_supplr_cd"),
)

# Price columns that listing rows take from the event, not the server hotel.
LISTING_FROM_EVENT = ("room_name", "room_type", "prc_aaj_ka_bhao_flg")
# Price columns that are an empty string off detail and listing rows.
EMPTY_ELSEWHERE = ("room_code", "htl_meal_plan_code", "htl_rate_plan_code")


def _price_rule(target: str, field: str) -> Rule:
    elsewhere = EMPTY if target in EMPTY_ELSEWHERE else field
    listing = elsewhere if target in LISTING_FROM_EVENT else f"server.{field}"
    return rule(target, elsewhere, detail=f"tariff.{field}", listing=listing)


PRICE = [
    *[_price_rule(target, field) for target, field in PRICE_FIELDS],
    rule("srvr_hotel_rank", null("int"), "int", listing="server.pd_htl_rank"),
    rule("hotel_searched", EMPTY, "string", listing="server.pd_is_htl_srch"),
]

# Coupon columns, in output order.
COUPON = [
    rule("cpn_dd_surge_amt", "coupon.cpn_dd_surge_amt", "double"),
    rule("cpn_wal_intnsty_prcnt", "coupon.cpn_wal_intnsty_prcnt", "double"),
    rule("cpn_wal_ded_amt", "coupon.cpn_wal_ded_amt", "double"),
    rule("cpn_blckd_m", "coupon.cpn_blckd_m", "boolean"),
    rule("cpn_spl_promo", "coupon.cpn_spl_promo", "boolean"),
    rule("cpn_cd", "coupon.cpn_cd"),
    rule("cpn_amt", "coupon.cpn_amt", "double"),
    rule("cpn_orig_amt", "coupon.cpn_orig_amt", "double"),
    rule("cpn_dbl_dis", "coupon.cpn_dbl_dis", "boolean"),
    rule("cpn_cashbck_amt", "coupon.cpn_cashbck_amt", "double"),
    rule("cpn_mode_typ", "coupon.cpn_mode_typ"),
    rule("cpn_status", "coupon.cpn_status"),
    rule("cpn_wal_pls_amt_ded", "coupon.cpn_wal_pls_amt_ded", "double"),
    rule("cpn_dis_types_arr", "coupon.cpn_dis_types", "join"),
    rule("cpn_hotelier_discount", "coupon.prc_hotelier_coupon_discount"),
    rule("cpn_hotelier_gst_discount", "coupon.prc_hotelier_gst_discount"),
    rule("cpn_brin_offer_price", "coupon.prc_brin_offer_price"),
    rule("cpn_dd_applicable", "coupon.cpn_dd_applcbl"),
]

# Location columns, in output order.
LOCATION_OUT = [
    rule("loc_state_code", "locus.pd_loc_st_code"),
    rule("loc_city_code", "locus.pd_loc_city_cd"),
    rule("loc_area_codes_arr", "locus.pd_loc_area_cds", "join"),
    rule("loc_region_codes_arr", "locus.pd_loc_reg_cds", "join"),
    rule("loc_country_code", "locus.pd_loc_ctry_cd"),
    rule("loc_is_locus", "locus.pd_is_locus"),
    rule("loc_state_code_srvr", "locus.pd_srvr_loc_st_cd", listing="server.locus_hotel.pd_srvr_loc_st_cd"),
    rule("loc_city_code_srvr", "locus.pd_srvr_loc_city_cd", listing="server.locus_hotel.pd_srvr_loc_city_cd"),
    rule(
        "loc_region_codes_arr_srvr",
        "locus.pd_srvr_loc_reg_cds",
        "join",
        listing="server.locus_hotel.pd_srvr_loc_reg_cds",
    ),
    rule(
        "loc_area_codes_arr_srvr",
        "locus.pd_srvr_loc_area_cds",
        "join",
        listing="server.locus_hotel.pd_srvr_loc_area_cds",
    ),
    rule("loc_country_code_srvr", "locus.pd_srvr_loc_ctry_cd", listing="server.locus_hotel.pd_srvr_loc_ctry_cd"),
    rule("loc_location_id", "locus.location_id", listing="server.locus_hotel.location_id"),
    rule("loc_location_type", "locus.location_type", listing="server.locus_hotel.location_type"),
    rule("loc_poi_name", "locus.poi_ls.poi_nm", "first"),
    rule("loc_poi_code", "locus.poi_ls.poi_cd", "first"),
    rule("loc_poi_lat", "locus.poi_ls.poi_lat", "first"),
    rule("loc_poi_long", "locus.poi_ls.poi_long", "first"),
    rule("loc_poi_type", "locus.poi_ls.poi_type", "first"),
    rule("loc_hotel_code", "locus.pd_loc_htl_cd"),
    rule("loc_mm_applied_listing", "locus.pd_mm_applied_listing"),
]

# Location columns the older layout never had, not even as ''.
NOT_IN_OLDER = ("loc_hotel_code", "loc_mm_applied_listing")

# Of a day's events in the older layout: what is an empty text there, and what is NULL.
EMPTY_IN_OLDER = {spec.target for spec in LOCATION_OUT if spec.target not in NOT_IN_OLDER} | {"loc_search_type", "loc_search_text"}
NULL_IN_OLDER = {*NOT_IN_OLDER, *[spec.target for spec in CURRENT_ONLY]}


def fact_columns(has_location: bool, has_rank: bool = True) -> list[Rule]:
    """The 184 fact columns before the dimension, in order.

    Server hotels without a rank are of a layout that has no search flag
    either: there it is an empty string.
    """
    price = PRICE if has_rank else [*PRICE[:-1], replace(PRICE[-1], on_step={})]
    if has_location:
        return [*COMMON, *price, *COUPON, *LOCATION_OUT]
    location = [
        replace(spec, source=null("string") if spec.target in NOT_IN_OLDER else EMPTY, convert=None, on_step={})
        for spec in LOCATION_OUT
    ]
    return [*COMMON, *price, *COUPON, *location]


def raw_paths() -> set[str]:
    """Every raw path the facts depend on, for the scan to read and no more."""
    wanted = paths(prepared_columns(True)) - {TARIFFS, DISPLAYED, SERVER_HOTELS, EVENT_COUPONS, LOCATION}
    opened = {"shown": DISPLAYED, "server": SERVER_HOTELS, "tariff": TARIFFS}
    for path in paths(fact_columns(True)):
        head, _, rest = path.partition(".")
        if head in opened:
            wanted.add(f"{opened[head]}.{rest}")
        elif head == LOCATION:
            wanted.add(path)
        elif head == "coupon":
            holders = (EVENT_COUPONS, f"{TARIFFS}.{TARIFF_COUPONS}", f"{SERVER_HOTELS}.{SERVER_COUPONS}")
            wanted.update(f"{holder}.{rest}" for holder in holders)
    # What choosing and matching read beyond the output.
    return wanted | {f"{TARIFFS}.pd_htl_lowest_trff", f"{SERVER_HOTELS}.pd_htl_id"}
