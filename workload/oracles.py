"""DuckDB SQL that states each query's result independently.

The statements never build nested values: an array of ``workload.nested`` is a
range of positions, and its elements' fields are arithmetic on the event's
columns and the position.
"""

from __future__ import annotations

import re

from workload import wide
from workload.queries import CHECKED, DAY, FINISHED

ORACLES: dict[str, str] = {}


_WHOLE = r"regexp_extract(amount, '^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$', 1)"

ORACLES["cast_decimal_text"] = f"""
WITH lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE l_orderkey % 8
    WHEN 0 THEN l_partkey || '.0' WHEN 1 THEN l_partkey || '.7' WHEN 2 THEN '-' || l_partkey || '.9'
    WHEN 3 THEN ' ' || l_partkey || ' ' WHEN 4 THEN l_partkey || '.' WHEN 5 THEN '1e' || l_partkey
    WHEN 6 THEN '7' || l_partkey || '000.5' ELSE '' END AS amount
  FROM lineitem
)
SELECT *, TRY_CAST({_WHOLE} AS SMALLINT) AS as_smallint, TRY_CAST({_WHOLE} AS INTEGER) AS as_int,
  TRY_CAST({_WHOLE} AS BIGINT) AS as_bigint
FROM lines
"""


def status(k: str) -> str:
    return (
        f"CASE ({k}) % 5 WHEN 0 THEN 'BEST_COUPON' WHEN 1 THEN 'OTHER_COUPON'"
        " WHEN 2 THEN 'RECOMMEND' WHEN 4 THEN 'REDEEMED' END"
    )


def opened(of: str, n: str, position: str) -> str:
    """Outer-opens an array of ``n`` elements as a lateral range; NULL or 0 keeps the row."""
    return f"{of} LEFT JOIN LATERAL (SELECT unnest(range(CAST(coalesce({n}, 0) AS BIGINT))) AS {position}) ON true"


def types_of(j: str) -> str:
    return f"CASE WHEN {j} % 2 = 0 THEN 'a,b' || {j} ELSE '' END"


EVENTS = f"""ev AS (
  SELECT l_partkey AS p, l_suppkey AS s, l_linenumber AS ln, CAST(l_quantity AS INT) AS q, l_extendedprice AS price,
    CASE WHEN l_linenumber = 7 AND l_partkey % 50 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS id,
    CASE WHEN l_quantity = 50 THEN NULL WHEN l_returnflag = 'R' THEN 'detail' WHEN l_returnflag = 'A' THEN 'listing'
         WHEN l_linestatus = 'O' THEN 'Review' ELSE 'thankyou' END AS step,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rq,
    CASE WHEN l_suppkey % 20 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS pd_htl_id,
    'KIND-' || upper(l_linestatus) AS profile_type,
    TIMESTAMP '{DAY}' + to_seconds((l_partkey * 1009 + l_suppkey * 31) % 86400) - to_days(l_linenumber % 3) AS at_ts,
    CAST(l_shipdate AS DATE) AS checkin,
    CASE WHEN l_linenumber <> 3 THEN l_returnflag || ',' || l_linestatus ELSE '' END AS stars
  FROM lineitem)"""

# Sizes of the arrays, NULL where the array is.
TARIFFS = "CASE WHEN ln <> 6 THEN ln % 4 END"
DISPLAYED = "CASE WHEN ln <> 5 THEN s % 4 END"
SERVERS = "q % 5"
COUPONS = "CASE WHEN ln <> 2 THEN p % 4 END"

COUPON_ROWS = f"""{EVENTS},
cp AS (
  SELECT id AS meta_rw_id, rq AS meta_rq_id, CAST(j AS INT) AS pos,
    'e' || (p + j) AS cpn_cd, {status("p + 3 * j")} AS cpn_status
  FROM {opened("ev", COUPONS, "j")})"""

TARIFF_ROWS = f"""{EVENTS},
tr AS (
  SELECT ev.*, CAST(i AS INT) AS pos, 'room-' || (p * 10 + i) AS room,
    CASE WHEN (p + i) % 11 <> 0 THEN price + ((s + 7 * i) % 5) * 10 END AS offer, (s + i) % 3 = 0 AS lowest
  FROM {opened("ev", TARIFFS, "i")})"""

ORACLES["project_cast_rename"] = """
WITH t AS (
  SELECT *, CAST(c_custkey * 37 AS VARCHAR) AS key_text, c_custkey % 5 AS k FROM customer)
SELECT c_custkey AS customer_id, lower(c_mktsegment) AS segment, upper(c_name) AS name,
  TRY_CAST(key_text AS SMALLINT) AS key_short, TRY_CAST(key_text AS INT) AS key_int,
  TRY_CAST(key_text AS BIGINT) AS key_long, c_nationkey + CAST(0.25 AS DOUBLE) AS rate,
  CASE k WHEN 0 THEN true WHEN 1 THEN false WHEN 3 THEN true END AS flag,
  CASE k WHEN 3 THEN CAST(1 AS BIGINT) END AS flag_long,
  TRY_CAST(CASE WHEN c_nationkey BETWEEN 1 AND 12 THEN '1998-' || c_nationkey || '-15' END AS DATE) AS day,
  c_mktsegment AS label, CAST(NULL AS VARCHAR) AS absent
FROM t"""

ORACLES["join_array_text"] = f"""
WITH {EVENTS},
cp AS (
  SELECT rq, string_agg('e' || (p + j), ',' ORDER BY j) AS coupons,
    string_agg({status("p + 3 * j")}, ',' ORDER BY j) AS statuses
  FROM {opened("ev", COUPONS, "j")} WHERE j IS NOT NULL GROUP BY rq)
SELECT ev.rq AS meta_rq_id, stars, coalesce(coupons, '') AS coupons, coalesce(statuses, '') AS statuses
FROM ev LEFT JOIN cp ON ev.rq = cp.rq"""

ORACLES["struct_and_first_element"] = f"""
WITH {EVENTS}
SELECT rq AS meta_rq_id, 'C' || (s % 7) AS city, CASE WHEN p % 2 = 1 THEN 'poi' || p END AS poi_name,
  CASE WHEN p % 2 = 1 THEN p / CAST(10 AS DOUBLE) END AS poi_lat,
  CASE WHEN ({COUPONS}) > 0 THEN 'e' || p END AS first_coupon
FROM ev"""

ORACLES["step_columns"] = """
SELECT event_id,
  CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN CAST(event_id AS DOUBLE) ELSE value END AS amount,
  CASE event_type WHEN 'view' THEN '' ELSE CAST(user_id AS VARCHAR) END AS who,
  CAST(CASE event_type WHEN 'click' THEN user_id END AS INT) AS rank, '' AS note, CAST(0 AS INT) AS meta_row_type
FROM events"""

ORACLES["epoch_day"] = f"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(ts, '%Y-%m-%d') AS day_text,
  DATE '{DAY}' AS event_date
FROM events"""

ORACLES["step_filters"] = """
WITH t AS (
  SELECT CASE WHEN user_id % 17 <> 0 THEN event_type END AS step, CASE WHEN event_id % 3 <> 0 THEN event_id END AS id
  FROM events)
SELECT coalesce(step, 'none') AS step, count(*) AS events,
  count(*) FILTER (WHERE step = 'click') AS on_click, count(*) FILTER (WHERE step <> 'click') AS off_click,
  count(*) FILTER (WHERE step NOT IN ('click', 'view')) AS off_both,
  count(*) FILTER (WHERE CASE WHEN step = 'view' THEN id IS NOT NULL ELSE true END) AS view_needs_id,
  count(*) FILTER (WHERE step = 'error' OR step IS NULL) AS error_or_null
FROM t GROUP BY 1"""

ORACLES["explode_outer"] = f"WITH {TARIFF_ROWS} SELECT rq AS meta_rq_id, room, offer AS price FROM tr"

ORACLES["posexplode_outer"] = f"WITH {COUPON_ROWS} SELECT * FROM cp"

ORACLES["array_match"] = f"""
WITH {EVENTS},
shown AS (SELECT ev.*, d FROM ev, LATERAL (SELECT unnest(range(CAST(coalesce({DISPLAYED}, 0) AS BIGINT))) AS d)),
served AS (SELECT rq, p, k FROM ev, LATERAL (SELECT unnest(range(CAST({SERVERS} AS BIGINT))) AS k))
SELECT shown.rq AS meta_rq_id, CAST(d AS INT) AS position, CAST(2 * d + 1 AS INT) AS shown_rank,
  CAST(k + 1 AS VARCHAR) AS server_rank
FROM shown JOIN served ON shown.rq = served.rq
  AND CASE WHEN (shown.p + d) % 13 <> 0 THEN shown.p + d END = served.p + k % 3"""

ORACLES["cheapest_item"] = f"""
WITH {TARIFF_ROWS},
w AS (SELECT *, CASE WHEN lowest THEN price ELSE price * 1000 END AS weight FROM tr),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY weight NULLS FIRST, pos NULLS FIRST, rq) AS n FROM w)
SELECT id AS meta_rw_id, rq AS meta_rq_id, pos, room, weight FROM r WHERE n = 1"""

ORACLES["cheapest_item_plain"] = f"""
WITH {TARIFF_ROWS},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY offer NULLS FIRST, pos NULLS FIRST, rq) AS n FROM tr)
SELECT id AS meta_rw_id, rq AS meta_rq_id, pos, room, offer AS price FROM r WHERE n = 1"""

BY_OFFER = "CASE WHEN lowest THEN 0 ELSE 1 END, offer NULLS LAST, coalesce(pos, 2147483647)"
BY_EVENT_PRICE = (
    "CASE WHEN lowest THEN price ELSE price * 1000 END NULLS FIRST, coalesce(pos, 2147483647)"
)


def best_tariffs(source: str, order: str) -> str:
    """``won``: the one event and tariff per row id."""
    return f"""{TARIFF_ROWS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}, at_ts, rq) AS n FROM {source}),
won AS (SELECT * FROM ranked WHERE n = 1)"""


ORACLES["best_tariff"] = f"""
WITH {best_tariffs("(SELECT * FROM tr WHERE id IS NOT NULL)", BY_OFFER)}
SELECT id AS meta_rw_id, rq AS meta_rq_id, room, offer AS price FROM won"""

ORACLES["status_pivot"] = f"""
WITH {COUPON_ROWS},
m AS (
  SELECT meta_rw_id, min(pos) FILTER (WHERE cpn_status = 'BEST_COUPON') AS best,
    min(pos) FILTER (WHERE cpn_status = 'REDEEMED') AS redeemed,
    min(pos) FILTER (WHERE cpn_status = 'OTHER_COUPON') AS other
  FROM cp GROUP BY 1)
SELECT *, coalesce(best, redeemed, other) AS chosen FROM m"""


def priority_pick(*priorities: str, keep_unmatched: bool = False) -> str:
    minima = ", ".join(
        f"min(pos) FILTER (WHERE cpn_status = '{s}') OVER (PARTITION BY meta_rw_id)" for s in priorities
    )
    unmatched = " OR chosen IS NULL" if keep_unmatched else ""
    return f"""
WITH {COUPON_ROWS},
c AS (SELECT *, coalesce({minima}) AS chosen FROM cp)
SELECT meta_rw_id, meta_rq_id, pos, cpn_cd, cpn_status FROM c
WHERE meta_rw_id IS NOT NULL AND (pos = chosen OR cpn_status IS NULL{unmatched})"""


ORACLES["priority_pick"] = priority_pick("BEST_COUPON", "OTHER_COUPON")
ORACLES["priority_pick_three"] = priority_pick("BEST_COUPON", "REDEEMED", "OTHER_COUPON")
ORACLES["priority_pick_keep_unmatched"] = priority_pick("BEST_COUPON", "OTHER_COUPON", keep_unmatched=True)

ORACLES["recommended_or_null"] = f"""
WITH {COUPON_ROWS}
SELECT meta_rq_id, cpn_cd, cpn_status FROM cp WHERE cpn_status = 'RECOMMEND' OR cpn_status IS NULL"""

ORACLES["shared_row_ids"] = f"""
WITH {EVENTS} SELECT id AS meta_rw_id FROM ev WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1"""

ORACLES["dim_enrich"] = """
SELECT c_custkey, c.nation, CAST(n_nationkey AS VARCHAR) AS mmt_hotel_id, lower(n_name) AS city_code,
  upper(n_name) AS htl_city_code
FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END AS nation FROM customer) c
LEFT JOIN nation ON c.nation = n_nationkey"""

HOTELS = """hotels AS (
  SELECT CAST(p_partkey AS VARCHAR) AS mmt_hotel_id, lower(p_brand) AS city_code, upper(p_brand) AS htl_city_code FROM part
  UNION
  SELECT CAST(p_partkey AS VARCHAR), lower(p_type), upper(p_type) FROM part WHERE p_partkey % 10 = 0)"""

ORACLES["ambiguous_hotels"] = f"""
WITH {HOTELS} SELECT mmt_hotel_id, count(*) AS rows FROM hotels GROUP BY 1 HAVING count(*) > 1"""

ORACLES["name_and_product"] = """
SELECT p_partkey AS id, CASE WHEN p_size <> 7 THEN p_brand || ' ' || p_type ELSE p_brand END AS name,
  CAST(p_size AS BIGINT) * 21 AS steps_to_desk
FROM part"""

ORACLES["mean_and_count"] = "SELECT count(*) AS rows, avg(l_quantity) AS avg_l_quantity FROM lineitem"

ORACLES["schema_enforced"] = """
SELECT event_id % 2 = 0 AS even, event_id, CASE WHEN user_id % 4 <> 0 THEN CAST(user_id AS INT) END AS user_id,
  TRY_CAST(event_id * 11 AS SMALLINT) AS small, user_id + CAST(0.5 AS DOUBLE) AS half, CAST(ts AS DATE) AS day,
  CAST(NULL AS VARCHAR) AS not_there
FROM events"""

ORACLES["branch_union"] = """
SELECT event_id, user_id, event_type, value, CAST(NULL AS BIGINT) AS seen_by, CAST(NULL AS VARCHAR) AS kind
FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, NULL, event_type, NULL, user_id, NULL FROM events WHERE event_type = 'view'
UNION ALL
SELECT event_id, user_id, event_type, value, NULL, upper(event_type) FROM events WHERE event_type NOT IN ('click', 'view')"""

ORACLES["csv_dim"] = "SELECT c_mktsegment, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer"

ORACLES["table_roundtrip"] = "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"

ORACLES["prepared_events"] = f"""
WITH {EVENTS}
SELECT rq AS meta_rq_id, step AS meta_fnnl_step, strftime(at_ts, '%Y-%m-%d %H:%M:%S') AS record_processed_ts,
  strftime(at_ts, '%Y-%m-%d %H:%M:%S') AS record_pdt_ts,
  strftime(at_ts + to_days(1), '%Y-%m-%d %H:%M:%S') AS record_client_ts, strftime(at_ts, '%Y-%m-%d') AS browsing_date,
  stars AS filter_star_arr, '' AS bkg_chld_id_arr, '' AS room_code, CAST(NULL AS VARCHAR) AS domain_sbu,
  'C' || (s % 7) AS pd_loc_city_cd, 'E' || p AS location_id, CASE WHEN p % 2 = 1 THEN 'poi' || p END AS poi_nm,
  CASE WHEN p % 2 = 1 THEN p / CAST(10 AS DOUBLE) END AS poi_lat
FROM ev"""

# Fields of the displayed hotel at position d; NULL where there is none.
SHOWN_ID = "CASE WHEN (p + d) % 13 <> 0 THEN CAST(p + d AS VARCHAR) END"
SHOWN_PRICE = "CASE WHEN (p + d) % 7 <> 0 THEN p + d + CAST(0.5 AS DOUBLE) END"

ORACLES["display_expanded"] = f"""
WITH {EVENTS},
sh AS (SELECT ev.*, d, {SHOWN_ID} AS shown_id FROM {opened("ev", DISPLAYED, "d")} WHERE step <> 'detail')
SELECT rq AS meta_rq_id, step AS meta_fnnl_step, CAST(d AS INT) AS pos, shown_id,
  CAST(2 * d + 1 AS INT) AS pd_htl_rnk_disp
FROM sh WHERE step <> 'listing' OR shown_id IS NOT NULL"""

# Fact columns that do not depend on the step.
COMMON = """profile_type, pd_htl_id, lower(step) AS meta_fnnl_step, rq AS correlation_key,
  strftime(at_ts, '%Y-%m-%d %H:%M:%S') AS record_pdt_ts, strftime(at_ts + to_days(1), '%Y-%m-%d %H:%M:%S') AS record_client_ts,
  strftime(at_ts, '%Y-%m-%d') AS browsing_date, id AS meta_row_id, p * 1000 AS time_spent,
  CASE WHEN q % 10 <> 0 AND q * 1000 <= 32767 THEN CAST(q * 1000 AS SMALLINT) END AS ap, checkin AS checkin_date,
  CASE ln % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_multi_room, stars AS filter_star_arr,
  'C' || (s % 7) AS loc_city_code, 'r1,r' || (s % 3) AS loc_region_codes_arr,
  CASE WHEN p % 2 = 1 THEN 'poi' || p END AS loc_poi_name,
  CASE WHEN p % 2 = 1 THEN p / CAST(10 AS DOUBLE) END AS loc_poi_lat"""


def coupon_fields(code: str, state: str, j: str = "j") -> str:
    """Coupon columns; ``j`` is NULL where there is no coupon."""
    return f"""CASE WHEN {j} IS NOT NULL THEN {code} END AS cpn_cd,
  CASE WHEN (p + {j}) % 6 <> 0 THEN CAST((p + {j}) % 90 AS DOUBLE) END AS cpn_amt,
  CASE WHEN {j} IS NOT NULL THEN {state} END AS cpn_status,
  CASE WHEN {j} IS NOT NULL THEN {types_of(j)} ELSE '' END AS cpn_dis_types_arr"""


def detail_facts(order: str, keep_unmatched: bool = False) -> str:
    unmatched = " OR chosen IS NULL" if keep_unmatched else ""
    coupons = "CASE WHEN pos IS NOT NULL THEN (s + pos) % 4 END"
    best, other = ("min(j) FILTER (WHERE state = '%s') OVER (PARTITION BY id)" % s for s in ("BEST_COUPON", "OTHER_COUPON"))
    return f"""{best_tariffs("(SELECT * FROM tr WHERE step = 'detail' AND id IS NOT NULL)", order)},
dc AS (SELECT won.*, j, CASE WHEN j IS NOT NULL THEN {status("p + pos + j")} END AS state FROM {opened("won", coupons, "j")}),
dk AS (SELECT *, coalesce({best}, {other}) AS chosen FROM dc),
detail AS (
  SELECT pd_htl_id AS hotel_id, {COMMON}, '' AS pd_htl_id_htdsp, CAST(NULL AS BOOLEAN) AS is_free_cncl,
    CAST(NULL AS BOOLEAN) AS is_htl_sold_out, CAST(NULL AS INT) AS pd_htl_rnk_disp,
    CAST(NULL AS INT) AS htl_rnk_disp_order, CAST(NULL AS DOUBLE) AS disp_sell_amt,
    CASE WHEN pos IS NOT NULL THEN room END AS room_code, offer AS prc_sell_amt_w_tax,
    CAST(NULL AS INT) AS srvr_hotel_rank, '' AS hotel_searched,
    {coupon_fields("'t' || (p + 10 * pos + j)", "state")},
    '' AS loc_region_codes_arr_srvr, 'E' || p AS loc_location_id
  FROM dk WHERE j = chosen OR state IS NULL{unmatched})"""


def listing_rows(name: str, where: str) -> str:
    """``name``: displayed hotels with their server twins and kept coupons."""
    return f"""
{name}_shown AS (
  SELECT ev.*, d, {SHOWN_ID} AS shown_id
  FROM ev, LATERAL (SELECT unnest(range(CAST(coalesce({DISPLAYED}, 0) AS BIGINT))) AS d) WHERE {where}),
{name}_pairs AS (
  SELECT sh.*, k FROM {name}_shown sh, LATERAL (SELECT unnest(range(CAST({SERVERS} AS BIGINT))) AS k)
  WHERE shown_id = CAST(p + k % 3 AS VARCHAR)),
{name}_open AS (
  SELECT pr.*, j, CASE WHEN j IS NOT NULL THEN {status("p + k + j")} END AS state
  FROM {opened(name + "_pairs pr", "(p + k) % 3", "j")}),
{name} AS (SELECT * FROM {name}_open WHERE state = 'RECOMMEND' OR state IS NULL)"""


ON_LISTING = f"""shown_id AS hotel_id, {COMMON}, shown_id AS pd_htl_id_htdsp, k % 2 = 0 AS is_free_cncl,
  CAST(NULL AS BOOLEAN) AS is_htl_sold_out, CAST(2 * d + 1 AS INT) AS pd_htl_rnk_disp,
  CAST(d AS INT) AS htl_rnk_disp_order, {SHOWN_PRICE} AS disp_sell_amt, CAST(NULL AS VARCHAR) AS room_code,
  price + k AS prc_sell_amt_w_tax, CAST(k + 1 AS INT) AS srvr_hotel_rank, CAST(NULL AS VARCHAR) AS hotel_searched,
  {coupon_fields("'h' || (p + k + j)", "state")},
  'x,y' || k AS loc_region_codes_arr_srvr, 'L' || (p + k) AS loc_location_id"""

# The same rows on another step: event columns in the place of the server hotel's.
OFF_LISTING = f"""pd_htl_id AS hotel_id, {COMMON}, shown_id AS pd_htl_id_htdsp, s % 2 = 0 AS is_free_cncl,
  s % 3 = 0 AS is_htl_sold_out, CAST(2 * d + 1 AS INT) AS pd_htl_rnk_disp,
  CAST(d AS INT) AS htl_rnk_disp_order, CAST(NULL AS DOUBLE) AS disp_sell_amt, '' AS room_code,
  price AS prc_sell_amt_w_tax, CAST(NULL AS INT) AS srvr_hotel_rank, '' AS hotel_searched,
  {coupon_fields("'h' || (p + k + j)", "state")},
  '' AS loc_region_codes_arr_srvr, 'E' || p AS loc_location_id"""

LISTING_FACTS = f"""{listing_rows("ls", "step = 'listing'")},
listing AS (SELECT {ON_LISTING} FROM ls)"""

# The listing branch over all events but those of detail steps.
ALL_LISTED = f"""{listing_rows("al", "step <> 'detail'")},
listing AS (
  SELECT {ON_LISTING} FROM al WHERE step = 'listing'
  UNION ALL BY NAME
  SELECT {OFF_LISTING} FROM al WHERE step <> 'listing')"""


def other_facts() -> str:
    minima = ", ".join(
        f"min(CASE WHEN oj.state = '{s}' THEN j END)" for s in ("BEST_COUPON", "REDEEMED", "OTHER_COUPON")
    )
    return f"""
oc AS (
  SELECT ev.*, j, CASE WHEN j IS NOT NULL THEN {status("p + 3 * j")} END AS state
  FROM {opened("ev", COUPONS, "j")} WHERE step NOT IN ('detail', 'listing') AND id IS NOT NULL),
pk AS (SELECT id, coalesce({minima}) AS chosen FROM oc oj GROUP BY id),
ok AS (SELECT oc.* FROM oc JOIN pk ON oc.id = pk.id WHERE j = chosen OR state IS NULL),
od AS (SELECT ok.*, d, {SHOWN_ID} AS shown_id FROM {opened("ok", DISPLAYED, "d")}),
others AS (
  SELECT pd_htl_id AS hotel_id, {COMMON}, shown_id AS pd_htl_id_htdsp, s % 2 = 0 AS is_free_cncl,
    s % 3 = 0 AS is_htl_sold_out, CAST(2 * d + 1 AS INT) AS pd_htl_rnk_disp, CAST(d AS INT) AS htl_rnk_disp_order,
    CAST(NULL AS DOUBLE) AS disp_sell_amt, '' AS room_code, price AS prc_sell_amt_w_tax,
    CAST(NULL AS INT) AS srvr_hotel_rank, '' AS hotel_searched,
    {coupon_fields("'e' || (p + j)", "state")},
    '' AS loc_region_codes_arr_srvr, 'E' || p AS loc_location_id
  FROM od)"""


SELECTED = ", ".join(CHECKED)
ORACLES["detail_step"] = f"WITH {detail_facts(BY_OFFER)} SELECT {SELECTED} FROM detail"
ORACLES["detail_step_event_price"] = f"WITH {detail_facts(BY_EVENT_PRICE)} SELECT {SELECTED} FROM detail"
ORACLES["detail_step_keep_unmatched"] = f"WITH {detail_facts(BY_OFFER, True)} SELECT {SELECTED} FROM detail"
ORACLES["listing_step"] = f"WITH {EVENTS}, {LISTING_FACTS} SELECT {SELECTED} FROM listing"
ORACLES["listing_step_all_events"] = f"WITH {EVENTS}, {ALL_LISTED} SELECT {SELECTED} FROM listing"
ORACLES["other_steps"] = f"WITH {EVENTS}, {other_facts()} SELECT {SELECTED} FROM others"


def day_facts(columns: str, order: str = BY_OFFER, listing: str = LISTING_FACTS) -> str:
    return day_of(detail_facts(order), listing, other_facts(), columns)


def day_of(detail: str, listing: str, others: str, columns: str) -> str:
    return f"""
WITH {detail}, {listing}, {others}, {HOTELS},
facts AS (
  SELECT * FROM detail UNION ALL BY NAME SELECT * FROM listing UNION ALL BY NAME SELECT * FROM others),
finished AS (
  SELECT facts.*, CAST(0 AS INT) AS meta_row_type, mmt_hotel_id, city_code, htl_city_code, DATE '{DAY}' AS event_date
  FROM facts LEFT JOIN hotels ON hotel_id = mmt_hotel_id)
SELECT {columns} FROM finished"""


ORACLES["day_job"] = day_facts(", ".join(FINISHED))
ORACLES["fact_roundtrip"] = ORACLES["day_job"]

# The older layout has no location: its text columns are empty.
OLDER = {
    c: f"'' AS {c}" for c in FINISHED if c.startswith("loc_")
}
ORACLES["day_job_older_layout"] = day_facts(", ".join(OLDER.get(c, c) for c in FINISHED))

SHARED_ID = "CAST(l_orderkey AS VARCHAR) END AS id"
OWN_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) END AS id"
ORACLES["day_job_unique_ids"] = ORACLES["day_job"].replace(SHARED_ID, OWN_ID)

ORACLES["day_job_reference_mode"] = day_facts(", ".join(FINISHED), BY_EVENT_PRICE, ALL_LISTED)

# Where a day holds both layouts, events of the older one have NULL locations; a listing row's are its server hotel's.
LOCATED = "CAST(split_part(correlation_key, '-', 4) AS BIGINT) % 2 = 0"
MIXED = {
    c: f"CASE WHEN {LOCATED} THEN {c} END AS {c}"
    for c in ("loc_city_code", "loc_poi_name", "loc_poi_lat")
} | {
    "loc_region_codes_arr": f"CASE WHEN {LOCATED} THEN loc_region_codes_arr ELSE '' END AS loc_region_codes_arr",
    "loc_location_id": f"CASE WHEN {LOCATED} OR meta_fnnl_step = 'listing' THEN loc_location_id END AS loc_location_id",
}
ORACLES["day_mixed_layouts"] = day_facts(", ".join(MIXED.get(c, c) for c in FINISHED))

# Each row in its file's layout: an older one's location texts are empty, and its one number is NULL.
BY_FILE = {
    c: f"CASE WHEN {LOCATED} THEN {c} ELSE {empty} END AS {c}"
    for c in OLDER
    for empty in ("NULL" if c == "loc_poi_lat" else "''",)
}
ORACLES["day_layout_by_file"] = day_facts(", ".join(BY_FILE.get(c, c) for c in FINISHED))


def widened(facts: str, step: int, **more: str) -> str:
    """A step's facts with the columns of ``workload.wide`` beside those held here; ``more`` replaces what wide events hold too."""
    for column, sql in more.items():
        lacking = re.compile(rf"CAST\(NULL AS \w+\) AS {column}\b")
        assert len(lacking.findall(facts)) == 1
        facts = lacking.sub(lambda _: f"{sql} AS {column}", facts)
    head = re.compile(r"SELECT (pd_htl_id|shown_id) AS hotel_id,")
    assert len(head.findall(facts)) == 1
    columns = ", ".join(f"{sql[step]} AS {column}" for column, sql in wide.MORE.items())
    return head.sub(lambda found: f"{found[0]} {columns},", facts)


MAIN_PRICE = wide.fact_sql("pd_disp_sell_amt", wide.NUMBER, "0")
DETAIL_FULL = widened(detail_facts(BY_OFFER), 0, disp_sell_amt=MAIN_PRICE)
LISTING_FULL = widened(
    LISTING_FACTS, 1, room_code=wide.fact_sql("pd_htl_rm_cd", wide.TEXT, "k"),
    hotel_searched=wide.fact_sql("pd_is_htl_srch", wide.TEXT, "k"),
)
OTHERS_FULL = widened(other_facts(), 2, disp_sell_amt=MAIN_PRICE)
ALL_CHECKED = ", ".join([*CHECKED, *wide.MORE])
ORACLES["detail_step_full"] = f"WITH {DETAIL_FULL} SELECT {ALL_CHECKED} FROM detail"
ORACLES["listing_step_full"] = f"WITH {EVENTS}, {LISTING_FULL} SELECT {ALL_CHECKED} FROM listing"
ORACLES["other_steps_full"] = f"WITH {EVENTS}, {OTHERS_FULL} SELECT {ALL_CHECKED} FROM others"
ORACLES["day_job_full"] = day_of(DETAIL_FULL, LISTING_FULL, OTHERS_FULL, ", ".join([*FINISHED, *wide.MORE]))
