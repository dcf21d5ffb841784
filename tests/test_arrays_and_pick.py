import random

import pytest
from pyspark.sql import Window, functions as F

from lodgetrail.operators import arrays, combine, enrich, filters, pick, report
from tests.conftest import plan_of, rows


def test_open_array(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["x", "y"])], "id int, a array<string>")
    assert rows(arrays.open_array(df, "a", "e", "pos"), "id", "pos", "e") == [
        (1, None, None), (2, None, None), (3, 0, "x"), (3, 1, "y"),
    ]
    assert rows(arrays.open_array(df, "a", "e"), "id", "e") == [(1, None), (2, None), (3, "x"), (3, "y")]
    assert rows(arrays.open_array(df, "a", "e", outer=False), "id", "e") == [(3, "x"), (3, "y")]


PAIRED = "id int, d array<struct<k:string,n:int>>, s array<struct<k:string,m:int>>"


def test_matched_pairs(spark):
    df = spark.createDataFrame(
        [
            (1, [("a", 1), ("b", 2)], [("b", 7), ("a", 8), ("z", 9)]),
            (2, [("a", 1)], None),
            (3, None, [("a", 1)]),
            (4, [("a", 1), ("a", 2), (None, 3)], [("a", 5), ("a", 6), (None, 7)]),
        ],
        PAIRED,
    )
    out = df.select("id", F.explode(arrays.matched_pairs(F.col("d"), F.col("s"), "k")).alias("p"))
    assert rows(out, "id", "p.position", "p.left.k", "p.right.m") == [
        (1, 0, "a", 8), (1, 1, "b", 7), (4, 0, "a", 5), (4, 0, "a", 6), (4, 1, "a", 5), (4, 1, "a", 6),
    ]


def test_matched_pairs_equal_the_double_explode(spark):
    rng = random.Random(5)
    key = lambda: rng.choice(["a", "b", "c", None])
    data = [
        (i, [(key(), n) for n in range(rng.randrange(5))], [(key(), m) for m in range(rng.randrange(5))]) for i in range(60)
    ]
    df = spark.createDataFrame(data, PAIRED)
    matched = df.select("id", F.explode(arrays.matched_pairs(F.col("d"), F.col("s"), "k")).alias("p"))
    double = (
        df.select("id", "s", F.posexplode_outer("d").alias("pos", "x"))
        .select("id", "pos", "x", F.explode_outer("s").alias("y"))
        .where("x.k = y.k")
    )
    assert rows(matched, "id", "p.position", "p.left.n", "p.right.m") == rows(double, "id", "pos", "x.n", "y.m")


def test_least_keys(spark):
    df = spark.createDataFrame(
        [(1, [("b", None), ("c", 2.0), ("d", 1.0), ("e", 1.0)]), (2, []), (3, None), (4, [("z", None)])],
        "id int, a array<struct<n:string,p:double>>",
    )
    keys = arrays.least_keys(F.col("a"), lambda e: [e.getField("p").isNull(), e.getField("p")])
    out = df.withColumn("k", keys).withColumn("e", F.get("a", F.col("k.position")))
    assert rows(out, "id", "e.n", "k.position") == [(1, "d", 2), (2, None, None), (3, None, None), (4, "z", 0)]


COUPONS = [
    ("r1", 0, "BEST"), ("r1", 1, "OTHER"), ("r1", 2, None),
    ("r2", 0, "RECOMMEND"),
    ("r3", None, None),
    ("r4", 1, "OTHER"), ("r4", 2, "OTHER"),
    (None, 0, "BEST"),
]
SCHEMA = "id string, pos int, status string"


def picked(df, *statuses, **options):
    return pick.priority_pick(df, "id", "pos", "status", statuses, **options)


def test_priority_pick(spark):
    df = spark.createDataFrame(COUPONS, SCHEMA)
    assert rows(picked(df, "BEST", "OTHER"), "id", "pos") == [("r1", 0), ("r1", 2), ("r3", None), ("r4", 1)]
    kept = picked(df, "BEST", "OTHER", keep_unmatched=True)
    assert ("r2", 0) in rows(kept, "id", "pos") and kept.count() == 5


def test_priority_pick_without_the_best_status_in_the_data(spark):
    df = spark.createDataFrame([c for c in COUPONS if c[2] != "BEST"], SCHEMA)
    assert rows(picked(df, "BEST", "OTHER"), "id", "pos") == [("r1", 1), ("r1", 2), ("r3", None), ("r4", 1)]


def random_coupons(seed, n=400):
    rng = random.Random(seed)
    statuses = ["BEST", "REDEEMED", "OTHER", "RECOMMEND", None]
    return [
        (rng.choice(["hot", None] + [f"r{i}" for i in range(40)]), rng.choice([None, 0, 1, 2, 3]), rng.choice(statuses))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_priority_pick_against_brute_force_pivot_and_window(spark, seed):
    data, order = random_coupons(seed), ["BEST", "REDEEMED", "OTHER"]
    df = spark.createDataFrame(data, SCHEMA)
    expected = []
    for id_, pos, status in data:
        mine = [r for r in data if r[0] == id_ and r[1] is not None]
        firsts = [min((r[1] for r in mine if r[2] == s), default=None) for s in order]
        chosen = next((f for f in firsts if f is not None), None)
        if id_ is not None and (status is None or (pos is not None and pos == chosen)):
            expected.append((id_, pos, status))
    by_key = lambda r: tuple((v is not None, str(v)) for v in r)
    got = rows(picked(df, *order), "id", "pos", "status")
    assert got == sorted(expected, key=by_key)

    pivot = df.groupBy("id").pivot("status", order).agg(F.min("pos")).withColumnRenamed("id", "id_x")
    by_pivot = df.join(pivot, F.col("id") == F.col("id_x")).where(
        (F.col("pos") == F.coalesce(*order)) | F.col("status").isNull()
    )
    assert got == rows(by_pivot, "id", "pos", "status")

    per_id = Window.partitionBy("id")
    chosen = F.coalesce(*[F.min(F.when(F.col("status") == s, F.col("pos"))).over(per_id) for s in order])
    by_window = df.withColumn("c", chosen).where("id IS NOT NULL AND (pos = c OR status IS NULL)")
    assert got == rows(by_window, "id", "pos", "status")


def test_status_positions_need_no_job_and_miss_nothing(spark):
    df = spark.createDataFrame(COUPONS, SCHEMA)
    out = pick.status_positions(df, "id", "pos", "status", ["BEST", "ABSENT"])
    assert out.columns == ["id", "BEST", "ABSENT"]
    assert rows(out.where("id = 'r1'")) == [("r1", 0, None)]


def test_pick_inside_the_array_equals_the_opened_pick(spark):
    rng = random.Random(3)
    kinds = ["BEST", "OTHER", "RECOMMEND", None]
    data = [
        (f"r{i}", None if i % 9 == 0 else [(n, rng.choice(kinds)) for n in range(rng.randrange(5))]) for i in range(80)
    ]
    df = spark.createDataFrame(data, "id string, a array<struct<n:int,status:string>>")
    opened = arrays.open_array(df, "a", "c", "pos").select("id", "pos", "c.status")
    firsts = arrays.first_positions(F.col("a"), "status", ("BEST", "OTHER"))
    for keep_unmatched in (False, True):
        kept = arrays.picked_elements(F.col("a"), F.coalesce(*firsts), "status", keep_unmatched)
        inside = df.select("id", F.explode(kept).alias("c")).select("id", "c.n", "c.status")
        assert rows(inside) == rows(picked(opened, "BEST", "OTHER", keep_unmatched=keep_unmatched), "id", "pos", "status")


def test_picked_elements_at_foreign_positions(spark):
    array = "array(named_struct('n', 0, 's', 'A'), named_struct('n', 1, 's', CAST(NULL AS STRING)), NULL)"
    df = spark.range(1).selectExpr(f"{array} AS a", "explode(array(0, 1, 2, 7, NULL)) AS p")
    kept = arrays.picked_elements(F.col("a"), F.col("p"), "s")
    # An element without a status stays once, whether or not it is at the position.
    assert rows(df.select("p", F.transform(kept, lambda e: e.getField("n")))) == [
        (None, [1, None]), (0, [0, 1, None]), (1, [1, None]), (2, [1, None]), (7, [1, None]),
    ]


def test_top_one(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", 1, 1), ("b", None, 1), ("b", 0, 2)], "k string, v int, n int")
    out = pick.top_one(df, ["k"], [F.col("v"), F.col("n")])
    assert rows(out) == [("a", 1, 1), ("b", None, 1)]


def test_top_one_limits_before_its_only_shuffle(spark):
    plan = plan_of(pick.top_one(spark.range(100).selectExpr("id % 3 AS k", "id AS v"), ["k"], [F.col("v")]))
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before
    assert plan.count("Exchange hashpartitioning") == 1


def hot_rows(spark, n=60000):
    """A third of the rows under one id."""
    return spark.range(0, n, numPartitions=12).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('r', id % 5000) END AS id",
        "CAST(id % 4 AS INT) AS pos",
        "CASE id % 5 WHEN 0 THEN 'BEST' WHEN 1 THEN 'OTHER' END AS status",
        "repeat(CAST(id AS STRING), 20) AS payload",
    )


def split_skew(conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="100KB",
    )


def final_plan(df):
    df.collect()
    return plan_of(df)


def test_hot_row_id_is_split(spark, conf):
    split_skew(conf)
    df = hot_rows(spark)
    out = picked(df, "BEST", "OTHER")
    assert "skew=true" in final_plan(out)


def test_minima_combine_before_the_shuffle(spark):
    plan = plan_of(pick.chosen_positions(hot_rows(spark), "id", ["pos"]))
    assert "partial_min" in plan


def test_hot_and_null_dimension_keys_are_split(spark, conf):
    split_skew(conf)
    facts = hot_rows(spark).withColumn("id", F.when(F.col("id") != "hot", F.col("id")))
    dimension = spark.range(5000).selectExpr("concat('r', id) AS k", "id AS city").dropDuplicates()
    out = enrich.attach(facts, dimension, "id", "k")
    assert "skew=true" in final_plan(out)
    assert out.count() == 60000


def test_attach_fans_out_keeps_both_keys_and_compares_as_text(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "hotel_id int")
    dimension = spark.createDataFrame([("1", "A"), ("1", "B"), ("2", "C"), ("x", "D")], "mmt_hotel_id string, city string")
    out = enrich.attach(facts, dimension, "hotel_id", "mmt_hotel_id")
    assert rows(out) == [(None, None, None), (1, "1", "A"), (1, "1", "B"), (2, "2", "C"), (3, None, None)]
    assert rows(enrich.ambiguous_keys(dimension, "mmt_hotel_id")) == [("1", 2)]


def test_dimension_is_broadcast_only_within_the_bound(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    facts = spark.createDataFrame([("1",)], "k string")
    dimension = spark.createDataFrame([("1", "A"), ("2", "B")], "d string, c string")
    # Two rows of two letters and 64 bytes each.
    for bound, joined in ((132, "BroadcastHashJoin"), (131, "SortMergeJoin")):
        out = enrich.attach(facts, enrich.broadcast_if_small(dimension, bound), "k", "d")
        assert joined in plan_of(out) and rows(out) == [("1", "1", "A")]


def test_shared_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(pick.shared_keys(df, "k")) == [("a",)]


def test_step_filters(spark):
    df = spark.createDataFrame([("detail", 1), ("Detail", 2), ("listing", None), ("listing", 4), ("review", None), (None, 6)], "s string, v int")
    s = F.col("s")
    keep = lambda test: [r[0] for r in rows(df.where(test), "s")]
    assert keep(filters.on_step(s, "detail")) == ["detail"]
    assert keep(filters.off_steps(s, "detail")) == ["Detail", "listing", "listing", "review"]
    assert keep(filters.off_steps(s, "detail", "listing")) == ["Detail", "review"]
    assert keep(filters.needs_on_step(s, "listing", F.col("v"))) == [None, "Detail", "detail", "listing", "review"]
    assert keep(filters.is_or_null(s, "review")) == [None, "review"]


def test_union_of_unlike_branches(spark):
    a = spark.createDataFrame([(1, True, 1.5)], "i int, b boolean, d double")
    b = spark.createDataFrame([(2, "x", 2, "only")], "i bigint, b string, d int, e string")
    out = combine.union_branches(a, b)
    assert dict(out.dtypes) == {"i": "bigint", "b": "string", "d": "double", "e": "string"}
    assert rows(out, "i", "b", "d", "e") == [(1, "true", 1.5, None), (2, "x", 2.0, "only")]


def test_enforce_schema(spark):
    from pyspark.sql.types import IntegerType, ShortType, StringType, StructField, StructType

    df = spark.createDataFrame([("7", "70000", 1), ("", "5", 2)], "a string, b string, c int")
    schema = StructType([StructField("b", ShortType()), StructField("a", IntegerType()), StructField("z", StringType())])
    out = combine.enforce_schema(df, schema)
    assert out.dtypes == [("b", "smallint"), ("a", "int"), ("z", "string")]
    assert rows(out) == [(None, 7, None), (5, None, None)]


def test_desk_report(spark):
    names = [("Ada", "Moss"), ("Ben", "Reed"), ("Cy", None), ("Dee", "Hill"), ("Eve", "Lane"), ("Flo", "Park"), ("Gus", "West"), ("Hal", "York")]
    employees = spark.createDataFrame(
        [(i + 1, first, last, i // 2 + 1) for i, (first, last) in enumerate(names)],
        "id bigint, first_name string, second_name string, floor bigint",
    )
    out = report.desk_report(employees, 21)
    assert out.dtypes == [("id", "bigint"), ("name", "string"), ("steps_to_desk", "bigint")]
    assert rows(out)[2] == (3, "Cy", 42)
    assert tuple(report.rows_and_mean(out, "steps_to_desk").first()) == (8, 52.5)
