"""The steps and the day job on hand-written events."""

import os
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from lodgetrail.operators import combine
from lodgetrail.plans import day_job, layout, one_scan, prepare, steps
from lodgetrail.sources import readers, writers
from tests.conftest import plan_of, rows
from tests.events import MILLIS, coupon, event, frame, server, tariff

DAY = "2020-12-30"


def prepared(spark, *events):
    return prepare.prepare_events(frame(spark, *events))


def detail(spark, *events, **choices):
    return steps.detail_facts(prepared(spark, *events), **choices)


# Detail steps


def test_flagged_tariff_wins_then_price_then_position(spark):
    out = detail(
        spark,
        event("a", "detail", pd_htl_trff_srvr_ls=[tariff("r0", 1.0), tariff("r1", 9.0, True), tariff("r2", 8.0, True)]),
        event("b", "detail", pd_htl_trff_srvr_ls=[tariff("r0", None, False), tariff("r1", 5.0), tariff("r2", 5.0)]),
        event("c", "detail", pd_htl_trff_srvr_ls=[]),
        event("d", "detail"),
    )
    assert rows(out, "meta_row_id", "room_code", "prc_sell_amt_w_tax") == [
        ("a", "r2", 8.0), ("b", "r1", 5.0), ("c", None, None), ("d", None, None),
    ]


@pytest.mark.parametrize(
    "price, winner", [(None, "r0"), (0.0, "r0"), (-5.0, "r0"), (5.0, "r1")],
)
def test_weighted_event_price_order(spark, price, winner):
    # NULL and 0 weigh alike: the first wins. Below 0 the unflagged one weighs less.
    tariffs = [tariff("r0", 1.0, False), tariff("r1", 9.0, True)]
    out = detail(
        spark,
        event("a", "detail", prc_sell_amt_w_tax=price, pd_htl_trff_srvr_ls=tariffs),
        tariff_order=steps.EVENT_PRICE_ORDER,
    )
    assert rows(out, "room_code") == [(winner,)]


def test_events_sharing_a_row_id_compete_and_null_ids_drop(spark):
    events = [
        event("a", "detail", meta_rq_id="q1", pd_htl_trff_srvr_ls=[tariff("r1", 5.0)]),
        event("a", "detail", meta_rq_id="q2", pd_htl_trff_srvr_ls=[tariff("r2", 4.0)]),
        event("a", "detail", meta_rq_id="q3"),
        event(None, "detail", pd_htl_trff_srvr_ls=[tariff("r3", 1.0)]),
    ]
    for row_ids in (steps.SHARED, steps.FEW_SHARED):
        assert rows(detail(spark, *events, row_ids=row_ids), "correlation_key", "room_code") == [("q2", "r2")]
    unique = detail(spark, *events, row_ids=steps.UNIQUE)
    assert rows(unique, "room_code") == [(None,), ("r1",), ("r2",)]


def test_detail_coupons(spark):
    def with_coupons(row_id, coupons):
        return event(row_id, "detail", pd_htl_trff_srvr_ls=[tariff("r", 1.0, True, coupons)])

    events = [
        with_coupons("r1", [coupon("c0", "BEST_COUPON"), coupon("c1", "OTHER_COUPON"), coupon("c2")]),
        with_coupons("r2", [coupon("c0", "RECOMMEND")]),
        with_coupons("r3", None),
        with_coupons("r4", [coupon("c0", "REDEEMED"), coupon("c1", "OTHER_COUPON"), coupon("c2", "OTHER_COUPON")]),
    ]
    for row_ids in (steps.SHARED, steps.FEW_SHARED, steps.UNIQUE):
        out = detail(spark, *events, row_ids=row_ids)
        assert rows(out, "meta_row_id", "cpn_cd") == [("r1", "c0"), ("r1", "c2"), ("r3", None), ("r4", "c1")]
    kept = detail(spark, *events, keep_unmatched=True)
    assert ("r2", "c0") in rows(kept, "meta_row_id", "cpn_cd")


def test_detail_output(spark):
    coupons = [coupon("c", "BEST_COUPON", "12.5", ["x", None, "y"])]
    raw = event(
        "a", "detail", pd_htl_id="h", usr_prof_typ="biz", srch_ap="70000", pd_htl_fc=True, pd_htl_sold_out=True,
        pd_htl_trff_srvr_ls=[tariff("r", 2.0, True, coupons)],
        locus=("C", ["a", None, "b"], "L", [("poi", 1.5)]),
    )
    out = detail(spark, raw)
    assert out.columns == [r.target for r in layout.fact_columns(True)]
    got = out.first().asDict()
    expected = {
        "hotel_id": "h", "profile_type": "BIZ", "ap": None, "pd_htl_id_htdsp": "", "is_free_cncl": None,
        "is_htl_sold_out": None, "room_code": "r", "cpn_amt": 12.5, "cpn_dis_types_arr": "x,y", "loc_city_code": "C",
        "loc_region_codes_arr": "a,b", "loc_area_codes_arr": "", "loc_location_id": "L", "loc_poi_name": "poi",
        "loc_poi_lat": 1.5, "browsing_date": DAY, "srvr_hotel_rank": None, "hotel_searched": "",
    }
    assert {k: got[k] for k in expected} == expected
    assert dict(out.dtypes)["is_free_cncl"] == "boolean" and dict(out.dtypes)["htl_rnk_disp_order"] == "int"


def test_detail_has_one_shuffle_and_none_for_unique_ids(spark):
    p = prepared(spark, event("a", "detail"))
    assert plan_of(steps.detail_facts(p)).count("Exchange ") == 1
    assert "Exchange " not in plan_of(steps.detail_facts(p, row_ids=steps.UNIQUE))


# Listing and other steps

SHOWN = [("h1", 3, "10"), (None, 4, None), ("h2", 5, "bad")]


def test_listing(spark):
    out = steps.listing_facts(
        prepared(
            spark,
            event(
                "a", "listing", pd_htl_id="own", pd_htl_dtl_disp=SHOWN,
                pd_htl_srvr_ls=[
                    server("h2", "8", 2.0, [coupon("c0", "RECOMMEND"), coupon("c1", "BEST_COUPON"), coupon("c2")], ("L2", ["x", "y"])),
                    server("h1", "7", 1.0, None),
                    server("h1", "bad", 1.5, [coupon("c3", "OTHER_COUPON")]),
                    server("zz"),
                ],
            ),
            event(None, "listing", pd_htl_dtl_disp=[("h1", 1, None)], pd_htl_srvr_ls=[server("h1", "1")]),
            event("b", "review", pd_htl_dtl_disp=SHOWN, pd_htl_srvr_ls=[server("h1")]),
            event("c", "listing", pd_htl_dtl_disp=SHOWN),
        )
    )
    assert rows(
        out, "hotel_id", "pd_htl_id", "htl_rnk_disp_order", "disp_sell_amt", "srvr_hotel_rank", "prc_sell_amt_w_tax",
        "cpn_cd", "loc_location_id", "loc_region_codes_arr_srvr", "meta_row_id",
    ) == [
        ("h1", None, 0, None, 1, None, None, None, "", None),
        ("h1", "own", 0, 10.0, 7, 1.0, None, None, "", "a"),
        ("h2", "own", 2, None, 8, 2.0, "c0", "L2", "x,y", "a"),
        ("h2", "own", 2, None, 8, 2.0, "c2", "L2", "x,y", "a"),
    ]


def test_listing_of_all_events_takes_event_columns_off_the_step(spark):
    events = [
        event("b", "review", pd_htl_id="own", prc_sell_amt_w_tax=3.0, pd_htl_dtl_disp=SHOWN, pd_htl_srvr_ls=[server("h1", "9", 1.0)]),
        event("d", "detail", pd_htl_dtl_disp=SHOWN, pd_htl_srvr_ls=[server("h1")]),
    ]
    out = steps.listing_facts(prepared(spark, *events), listing_only=False)
    assert rows(out, "hotel_id", "pd_htl_id_htdsp", "prc_sell_amt_w_tax", "srvr_hotel_rank") == [("own", "h1", 3.0, None)]


def test_listing_needs_no_shuffle(spark):
    assert "Exchange " not in plan_of(steps.listing_facts(prepared(spark, event("a", "listing"))))


def test_listing_opens_pairs_and_their_coupons_at_once(spark):
    # Each opening copies the event's columns.
    shown = [("h1", 1, "1"), ("h2", 2, "2"), ("h3", 3, "3")]
    servers = [server("h1", "1", None, [coupon("c0", "RECOMMEND"), coupon("c1", "OTHER_COUPON"), coupon("c2"), None])]
    servers += [server("h2", "2", None, [coupon("c3", "OTHER_COUPON")]), server("h3", "3", None, []), server("h3", "4")]
    out = steps.listing_facts(prepared(spark, event("a", "listing", pd_htl_dtl_disp=shown, pd_htl_srvr_ls=servers)))
    assert plan_of(out).count("Generate ") == 1
    assert rows(out, "hotel_id", "srvr_hotel_rank", "cpn_cd") == [
        ("h1", 1, None), ("h1", 1, "c0"), ("h1", 1, "c2"), ("h3", 3, None), ("h3", 4, None),
    ]


OTHERS = [
    event("a", "review", meta_rq_id="1", pd_htl_dtl_disp=SHOWN, cpn_resp_ls=[coupon("c0", "OTHER_COUPON"), coupon("c1", "REDEEMED")]),
    event("a", "review", meta_rq_id="2", cpn_resp_ls=[coupon("d0", "BEST_COUPON"), coupon("d1", "RECOMMEND"), coupon("d2")]),
    event("b", "thankyou", meta_rq_id="3", cpn_resp_ls=[coupon("e0", "OTHER_COUPON"), coupon("e1", "REDEEMED")]),
    event("c", "thankyou", meta_rq_id="4"),
    event("e", "Detail", meta_rq_id="5", cpn_resp_ls=[coupon("f0", "RECOMMEND")]),
    event(None, "review", meta_rq_id="6"),
    event("f", None, meta_rq_id="7"),
    event("g", "listing", meta_rq_id="8"),
    event("h", "detail", meta_rq_id="9"),
]


@pytest.mark.parametrize("row_ids", [steps.SHARED, steps.FEW_SHARED])
def test_other_steps_settle_coupons_over_the_row_id(spark, row_ids):
    out = steps.other_facts(prepared(spark, *OTHERS), row_ids)
    # Position 0 is best for row id a, so its first event gives its own coupon at 0.
    assert rows(out, "correlation_key", "pd_htl_id_htdsp", "cpn_cd") == [
        ("1", None, "c0"), ("1", "h1", "c0"), ("1", "h2", "c0"),
        ("2", None, "d0"), ("2", None, "d2"), ("3", None, "e1"), ("4", None, None),
    ]


def test_other_steps_with_unique_ids(spark):
    events = [e for e in OTHERS if e[2] != "1"]
    by_mode = [rows(steps.other_facts(prepared(spark, *events), m)) for m in (steps.SHARED, steps.FEW_SHARED, steps.UNIQUE)]
    assert by_mode[0] == by_mode[1] == by_mode[2]
    assert "Exchange " not in plan_of(steps.other_facts(prepared(spark, *events), steps.UNIQUE))


def test_other_steps_keep_unmatched_and_lower_case(spark):
    out = steps.other_facts(prepared(spark, *OTHERS), keep_unmatched=True)
    assert ("detail", "f0") in rows(out, "meta_fnnl_step", "cpn_cd")


def test_display_expansion(spark):
    out = steps.display_expanded(
        prepared(
            spark, event("a", "listing", pd_htl_dtl_disp=SHOWN), event("b", "listing"), event("c", "review"),
            event("d", "detail", pd_htl_dtl_disp=SHOWN), event("e", None, pd_htl_dtl_disp=SHOWN),
        )
    )
    assert rows(out, "meta_rw_id", "pos", "shown.pd_htl_id") == [("a", 0, "h1"), ("a", 2, "h2"), ("c", None, None)]


def test_events_without_any_of_the_arrays(spark):
    raw = frame(spark, event("a", "detail"), event("b", "listing"), event("c", "review")).drop(
        "pd_htl_trff_srvr_ls", "pd_htl_srvr_ls", "pd_htl_dtl_disp", "cpn_resp_ls"
    )
    p = prepare.prepare_events(raw)
    assert rows(steps.detail_facts(p), "meta_row_id", "cpn_cd") == [("a", None)]
    assert rows(steps.listing_facts(p)) == []
    assert rows(steps.other_facts(p), "meta_row_id", "cpn_cd") == [("c", None)]


@pytest.mark.parametrize("keep_unmatched", [False, True])
@pytest.mark.parametrize("order", [steps.OFFER_ORDER, steps.EVENT_PRICE_ORDER])
def test_one_pass_gives_what_the_branches_give(spark, order, keep_unmatched):
    coupons = [coupon("c1", "OTHER_COUPON"), coupon("c2", "BEST_COUPON"), coupon("c3"), coupon("c4", "RECOMMEND")]
    events = [
        event("a", "detail", pd_htl_trff_srvr_ls=[tariff("r1", 3.0), tariff("r2", 2.0, True, coupons), tariff("r3", 1.0)]),
        event("b", "detail", pd_htl_trff_srvr_ls=[tariff("r1", None, None, [])], cpn_resp_ls=coupons),
        event("c", "detail", pd_htl_dtl_disp=SHOWN), event(None, "detail"), event("d", "detail", pd_htl_trff_srvr_ls=[]),
        event("e", "listing", pd_htl_dtl_disp=SHOWN, pd_htl_srvr_ls=[server("h1", coupons=coupons), server("h2"), server("h1", "9")]),
        event(None, "listing", pd_htl_dtl_disp=SHOWN, pd_htl_srvr_ls=[server("h2", coupons=[coupon("x", "OTHER_COUPON")])]),
        event("f", "listing", pd_htl_dtl_disp=SHOWN), event("g", "listing"),
        event("h", "review", pd_htl_dtl_disp=SHOWN, cpn_resp_ls=coupons), event("i", "review", cpn_resp_ls=coupons[2:]),
        event("j", "thankyou", pd_htl_dtl_disp=[], cpn_resp_ls=[]), event(None, "review", cpn_resp_ls=coupons), event("k", None),
        event("l", "review", cpn_resp_ls=coupons[3:]),
    ]
    arrays_of = ("pd_htl_trff_srvr_ls", "pd_htl_srvr_ls", "pd_htl_dtl_disp", "cpn_resp_ls")
    whole = frame(spark, *events)
    text_prices = whole.withColumn("prc_sell_amt_w_tax", F.lit("7.5")).withColumn("pd_htl_fc", F.lit("yes"))
    for raw in (whole, whole.drop("locus"), whole.drop(*arrays_of), text_prices, whole.limit(0), *[whole.drop(c) for c in arrays_of]):
        p = prepare.prepare_events(raw)
        branches = combine.union_branches(
            steps.detail_facts(p, order, steps.UNIQUE, keep_unmatched), steps.listing_facts(p),
            steps.other_facts(p, steps.UNIQUE, keep_unmatched),
        )
        once = one_scan.unique_facts(p, order, keep_unmatched)
        assert once.dtypes == branches.dtypes
        assert rows(once) == rows(branches)


def test_one_pass_reads_the_events_once_and_shuffles_nothing(spark, folders):
    raw = readers.read_events(spark, folders[0], DAY, layout.raw_paths())
    plan = plan_of(one_scan.unique_facts(prepare.prepare_events(raw)))
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan


# Dimension, day job and sink


def hotel_file(spark, path):
    spark.createDataFrame(
        [("x", "h1", "del"), ("y", "h1", "del"), ("z", "h2", "bom"), ("z", "h2", "goi")], "note string, hotel_id string, city_code string"
    ).write.option("header", True).option("sep", "|").csv(path)


def test_load_hotels(spark, tmp_path):
    path = f"file://{tmp_path}/hotels"
    hotel_file(spark, path)
    hotels = prepare.load_hotels(spark, path)
    assert hotels.dtypes == [("mmt_hotel_id", "string"), ("city_code", "string"), ("htl_city_code", "string")]
    assert rows(hotels) == [("h1", "del", "DEL"), ("h2", "bom", "BOM"), ("h2", "goi", "GOI")]


DAY_EVENTS = [
    event("a", "detail", pd_htl_id="h1", pd_htl_trff_srvr_ls=[tariff("r", 1.0)]),
    event("b", "listing", pd_htl_dtl_disp=SHOWN, pd_htl_srvr_ls=[server("h1"), server("h2")]),
    event("c", "review", pd_htl_id="h2", m124=MILLIS - 86400000),
    event("d", "review", pd_htl_id=None),
]


def write_events(spark, root, *events, day=DAY):
    frame(spark, *events).withColumn("date_part", F.lit(day)).write.mode("append").partitionBy("date_part").parquet(root)


@pytest.fixture
def folders(spark, tmp_path):
    base = f"file://{tmp_path}"
    write_events(spark, f"{base}/events", *DAY_EVENTS)
    write_events(spark, f"{base}/events", event("z", "detail"), day="2020-12-31")
    hotel_file(spark, f"{base}/hotels")
    return f"{base}/events", f"{base}/hotels", f"{base}/facts"


EXPECTED = [
    ("2020-12-29", "review", "c", "BOM"), ("2020-12-29", "review", "c", "GOI"),
    ("2020-12-30", "detail", "a", "DEL"),
    ("2020-12-30", "listing", "b", "BOM"), ("2020-12-30", "listing", "b", "DEL"), ("2020-12-30", "listing", "b", "GOI"),
    ("2020-12-30", "review", "d", None),
]


def written(spark, path):
    facts = spark.read.parquet(path)
    return rows(facts.withColumn("browsing_date", F.col("browsing_date").cast("string")), "browsing_date", "meta_fnnl_step", "meta_row_id", "htl_city_code")


@pytest.mark.parametrize("arrangement", writers.LAYOUTS)
def test_day_job_and_rerun(spark, folders, arrangement):
    for _ in range(2):
        path = day_job.run_day(spark, *folders[:2], DAY, folders[2], layout=arrangement)
    assert path == f"{folders[2]}/event_date={DAY}"
    assert written(spark, path) == EXPECTED
    facts = spark.read.parquet(path)
    assert len(facts.columns) == 189
    assert rows(facts.select("event_date", "meta_row_type").distinct()) == [(date(2020, 12, 30), 0)]


def stopped_after(monkeypatch, calls):
    """Let the process end after so many moves of folders."""
    real, left = writers._moved, [calls]

    def moved(*args):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        real(*args)

    monkeypatch.setattr(writers, "_moved", moved)


@pytest.mark.parametrize("moves", [0, 1])
def test_a_run_stopped_between_two_moves_is_finished_by_the_next(spark, folders, monkeypatch, moves):
    events, hotels, out = folders
    path = day_job.run_day(spark, events, hotels, DAY, out)
    write_events(spark, events, event("n", "review", pd_htl_id="h1"))
    with monkeypatch.context() as patched:
        stopped_after(patched, moves)
        with pytest.raises(KeyboardInterrupt):
            day_job.run_day(spark, events, hotels, DAY, out)
    files = os.listdir(out.removeprefix("file://"))
    assert (f"event_date={DAY}" in files) == (moves == 0)
    assert writers.finish_replacing(spark, path) and not writers.finish_replacing(spark, path)
    assert written(spark, path) == sorted([*EXPECTED, ("2020-12-30", "review", "n", "DEL")], key=str)
    assert [f for f in os.listdir(out.removeprefix("file://")) if not f.startswith(".")] == [f"event_date={DAY}"]


@pytest.mark.parametrize("lost", [False, True])
def test_a_move_file_by_file_that_was_stopped(spark, tmp_path, lost):
    """As on stores without folders: the fresh folder is copied, then removed file by file."""
    base = f"file://{tmp_path}"
    for name, n in (("day", 3), ("_fresh", 5)):
        spark.range(n).repartition(2).write.parquet(f"{base}/{name}")
    target, files = writers._folder(spark, f"{base}/day")
    count, size = writers._held(files, writers._folder(spark, f"{base}/_fresh")[0])
    (tmp_path / "_replacing-day").write_text(f"_fresh\n_old\n{count}\n{size}")
    os.rename(tmp_path / "day", tmp_path / "_old")
    shutil.copytree(tmp_path / "_fresh", tmp_path / "day")
    for part in list((tmp_path / "_fresh").glob("part-*"))[:1] + ([next((tmp_path / "day").glob("part-*"))] if lost else []):
        part.unlink()
    assert writers.finish_replacing(spark, f"{base}/day")
    assert spark.read.parquet(f"{base}/day").count() == (3 if lost else 5)
    assert sorted(f.name for f in tmp_path.iterdir() if not f.name.startswith(".")) == ["day"]


def test_a_write_that_fails_leaves_the_day_and_nothing_else(spark, folders):
    events, hotels, out = folders
    path = day_job.run_day(spark, events, hotels, DAY, out)
    bad = spark.read.parquet(path).withColumn("meta_row_id", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        day_job.write_day(bad.withColumn("event_date", F.lit(DAY)), out, DAY)
    assert written(spark, path) == EXPECTED
    assert [f for f in os.listdir(out.removeprefix("file://")) if not f.startswith(".")] == [f"event_date={DAY}"]


def test_append_doubles(spark, folders):
    for _ in range(2):
        path = day_job.run_day(spark, *folders[:2], DAY, folders[2], append=True)
    assert len(written(spark, path)) == 2 * len(EXPECTED)


def test_rerun_drops_stale_partitions_and_leaves_other_days(spark, folders):
    events, hotels, out = folders
    other = day_job.run_day(spark, events, hotels, "2020-12-31", out)
    path = day_job.run_day(spark, events, hotels, DAY, out)
    assert len(written(spark, path)) == len(EXPECTED)
    facts = day_job.day_facts(frame(spark, DAY_EVENTS[0]), prepare.load_hotels(spark, hotels), DAY)
    day_job.write_day(facts, out, DAY)
    assert written(spark, path) == [r for r in EXPECTED if r[2] == "a"]
    assert [r[2] for r in written(spark, other)] == ["z"]
    assert spark.read.parquet(out).select("event_date").distinct().count() == 2


def test_one_table_as_the_day_and_promised_row_ids(spark, folders):
    events, hotels, out = folders
    path = day_job.run_day(spark, f"{events}/date_part={DAY}", hotels, DAY, out, row_ids=steps.UNIQUE, partitioned=False)
    assert written(spark, path) == EXPECTED


def test_older_layout(spark, folders):
    raw = frame(spark, *DAY_EVENTS).drop("locus")
    facts = day_job.day_facts(raw, prepare.load_hotels(spark, folders[1]), DAY)
    assert len(facts.columns) == 189
    assert rows(facts.select("loc_city_code", "loc_hotel_code", "domain_sbu").distinct()) == [("", None, None)]


def test_measured_row_ids(spark):
    def measured(*events):
        return day_job.measured_row_ids(frame(spark, *events))

    a, b = event("x", "detail"), event("x", "review")
    many = [event(f"y{i}", "detail") for i in range(10)]
    assert measured(a, b, event(None, "detail"), event(None, "detail")) == (steps.UNIQUE, steps.UNIQUE)
    assert measured(a, a, b) == (steps.SHARED, steps.UNIQUE)
    assert measured(a, a, b, *many) == (steps.FEW_SHARED, steps.UNIQUE)
    assert measured(a, b, b) == (steps.UNIQUE, steps.FEW_SHARED)


def test_many_shared_row_ids_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(day_job, "BROADCAST_IDS", 0)
    a, b = event("x", "detail"), event("x", "review")
    assert day_job.measured_row_ids(frame(spark, a, a, b, b)) == (steps.SHARED, steps.SHARED)


def test_scan_reads_only_what_the_facts_need(spark, tmp_path):
    path = f"file://{tmp_path}/wide"
    wide = frame(spark, *DAY_EVENTS).selectExpr(
        "*", "1 AS never_read", "transform(pd_htl_dtl_disp, d -> struct(d.pd_htl_id, d.pd_htl_rnk_disp, 'x' AS unused)) AS d2"
    ).drop("pd_htl_dtl_disp").withColumnRenamed("d2", "pd_htl_dtl_disp")
    wide.write.parquet(path)
    raw = readers.read_events(spark, path, wanted=layout.raw_paths())
    assert "never_read" not in raw.columns
    assert "unused" not in raw.schema.simpleString() and "pd_htl_rnk_disp" in raw.schema.simpleString()
    plan = plan_of(steps.listing_facts(prepare.prepare_events(raw)))
    assert "unused" not in plan and "PushedFilters: [IsNotNull(meta_fnnl_step), EqualTo(meta_fnnl_step,listing)" in plan


def test_write_adds_no_sort_of_its_own_and_sorts_by_city(spark, folders):
    raw = frame(spark, *DAY_EVENTS)
    facts = day_job.day_facts(raw, prepare.load_hotels(spark, folders[1]), DAY)
    arranged = writers.arranged(facts, day_job.PARTITIONS, prepare.CITY)
    plan = plan_of(arranged)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert plan.index("Sort [browsing_date") < plan.index("REBALANCE")


def test_large_partition_is_written_by_several_tasks(spark, tmp_path, conf):
    conf(adaptive__advisoryPartitionSizeInBytes="200KB")
    df = spark.range(0, 200000, numPartitions=16).selectExpr(
        "'d' AS browsing_date", "'s' AS meta_fnnl_step", "concat('c', id % 7) AS htl_city_code", "uuid() AS meta_row_id"
    )
    path = f"file://{tmp_path}/big"
    for arrangement, spread in (("rebalance", None), ("range", "meta_row_id")):
        arranged = writers.arranged(df, day_job.PARTITIONS, prepare.CITY, arrangement, spread)
        writers.write_partitioned(arranged, path, day_job.PARTITIONS)
        back = spark.read.parquet(path)
        assert back.count() == 200000
        assert len(back.inputFiles()) > 2
    with pytest.raises(ValueError):
        writers.arranged(df, day_job.PARTITIONS, prepare.CITY, "other")


def test_plain_sinks(spark, tmp_path):
    df = spark.range(100).repartition(8)
    writers.write_delimited(df, f"file://{tmp_path}/csv")
    writers.write_table(df, f"file://{tmp_path}/table")
    assert len(spark.read.parquet(f"file://{tmp_path}/table").inputFiles()) == 1
    back = readers.read_delimited(spark, f"file://{tmp_path}/csv", ["id"], separator=",")
    assert back.dtypes == [("id", "string")] and back.count() == 100
    assert readers.read_table(spark, f"file://{tmp_path}/table").count() == 100
