"""Every driver query against its SQL counterpart, run by DuckDB on the same tables."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lodgetrail.plans import day_job as job, prepare, steps
from tests import opened_first
from tests.conftest import plan_of
from workload import nested, wide
from workload.oracles import ORACLES
from workload.queries import CHECKED, QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    return con


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    df = QUERIES[name](spark, DATA)
    plan = plan_of(df)
    assert "EvalPython" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert_same(tables, df.toArrow(), tables.sql(ORACLES[name]).to_arrow_table())


@pytest.mark.parametrize("name", ["day_job", "day_job_full", "day_job_unique_ids", "day_mixed_layouts"])
def test_facts_are_not_shuffled_for_a_small_dimension(spark, conf, monkeypatch, name):
    # Beyond Spark's threshold for tables in general, which a dimension of a million hotels passes.
    conf(autoBroadcastJoinThreshold="-1")
    assert "hashpartitioning(hotel_id" not in plan_of(QUERIES[name](spark, DATA))
    monkeypatch.setattr(job, "BROADCAST_HOTELS", 1000)
    assert "hashpartitioning(hotel_id" in plan_of(QUERIES[name](spark, DATA))


def assert_same(tables, got, expected):
    """Same columns, types and rows, in any order."""
    kinds = lambda t: {f.name: str(f.type) for f in t.schema}
    assert kinds(got) == kinds(expected)
    columns = ", ".join(f'"{c}"' for c in sorted(got.column_names))
    tables.register("got", got)
    tables.register("expected", expected)
    for a, b in (("got", "expected"), ("expected", "got")):
        extra = tables.sql(f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b} LIMIT 3").fetchall()
        assert not extra, f"only in {a}"


@pytest.mark.parametrize("row_ids", [steps.SHARED, steps.FEW_SHARED])
def test_steps_equal_the_form_that_opens_first(spark, tables, row_ids):
    prepared = prepare.prepare_events(nested.raw_events(spark, DATA))
    pairs = [
        (steps.detail_facts(prepared, row_ids=row_ids), opened_first.detail(prepared)),
        (steps.other_facts(prepared, row_ids), opened_first.others(prepared)),
    ]
    if row_ids == steps.SHARED:
        pairs.append((steps.listing_facts(prepared), opened_first.listing(prepared)))
    for ours, opened in pairs:
        assert ours.columns == opened.columns
        assert_same(tables, ours.select(*CHECKED).toArrow(), opened.select(*CHECKED).toArrow())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_the_full_queries_prove_every_column(spark, tables):
    prepared = prepare.prepare_events(nested.raw_events(spark, DATA))
    columns = steps.detail_facts(prepared).columns
    assert len(columns) == 184 and set(tables.sql(ORACLES["detail_step_full"]).columns) == set(columns)
    day = tables.sql(ORACLES["day_job_full"])
    assert len(day.columns) == 189
    told = tables.sql("SELECT " + ", ".join(f"count(DISTINCT nullif(\"{c}\"::VARCHAR, '')) AS \"{c}\"" for c in day.columns) + " FROM day")
    constant = {c for c, n in zip(told.columns, told.fetchall()[0]) if n < 2}
    assert constant == {"meta_row_type", "event_date"}


def test_no_two_fields_have_like_values(tables):
    all_ = (wide.EVENT, wide.EVENT_OR_SERVER, wide.SHOWN, wide.PRICE, wide.PRICE_OR_EVENT, wide.COUPON, wide.LOCATION, wide.SERVER_LOCATION)
    for kind in (wide.WHOLE, wide.NUMBER, wide.FLAG, wide.DATE):
        fields = {f for t in all_ for _, f, k in wide.lines(t) if k == kind}
        values = ", ".join(f"list(({wide.fact_sql(f, kind, '0')})::VARCHAR ORDER BY p)" for f in sorted(fields))
        row = tables.sql(f"SELECT {values} FROM range(400) t(p)").fetchall()[0]
        assert len({tuple(v) for v in row}) == len(fields)


def test_a_task_makes_a_bounded_number_of_events(spark):
    # 8 splits used to be enough for any number of rows on 8 cores.
    lines = spark.range(0, 1_000_000, 1, 8)
    dealt = nested.spread(lines)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.count() == 1_000_000
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 1.1 * nested.EVENTS_A_TASK


def test_arrays_of_events_are_compiled(spark):
    made = nested.listed("n", "i", "concat('a', i)")
    n = spark.sql("SELECT * FROM VALUES (NULL), (-1), (0), (2), (4) AS t(n)")
    assert [r[0] for r in n.selectExpr(made).collect()] == [[], [], [], ["a0", "a1"], ["a0", "a1", "a2", "a3"]]
    assert "lambda" not in plan_of(n.selectExpr(made))
