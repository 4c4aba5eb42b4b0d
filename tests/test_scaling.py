"""Shapes of the flight tables that decide what is shuffled and written."""

import datetime

import pytest
from pyspark.sql import functions as F

from skyframe.operators import clean
from skyframe.plans import flights as FL
from skyframe.plans import ordered


def star(spark, path, orders=40):
    day = datetime.datetime(1998, 3, 4)
    tables = {
        "lineitem": ([(o, n, o % 7, o % 5, 10.0 + n, 900.0 + o, 0.01 * n, 0.02, day) for o in range(orders) for n in range(1, 4)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"),
        "orders": ([(o, o % 4 if o else None) for o in range(orders)], "o_orderkey long, o_custkey long"),
        "customer": ([(c, c % 3) for c in range(4)], "c_custkey long, c_nationkey int"),
        "supplier": ([(s, s % 3) for s in range(5)], "s_suppkey long, s_nationkey int"),
        "nation": ([(n, f"NATION_{n}") for n in range(3)], "n_nationkey int, n_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_stored_flight_table_holds_only_the_columns_that_others_are_computed_from(spark, tmp_path):
    sf = star(spark, tmp_path)
    assert FL.flights_stored(spark, sf).columns == FL.CORE_FIELDS
    assert FL.flights_table(spark, sf).columns == [*FL.RAW_FIELDS, *FL.ROW_KEYS]


@pytest.mark.parametrize("most", [0, 500_000])
def test_flights_equal_their_sql_with_dimensions_broadcast_or_joined(spark, tmp_path, monkeypatch, most):
    sf = star(spark, tmp_path)
    monkeypatch.setattr(FL, "BROADCAST_ROWS", most)
    for t in ("lineitem", "orders", "customer", "supplier", "nation"):
        spark.read.parquet(f"{sf}/{t}.parquet").createOrReplaceTempView(t)
    got, want = FL.flights(spark, sf), spark.sql(FL.FLIGHTS_SQL)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(
        *[F.col(f.name).cast(f.dataType) for f in got.schema.fields]).collect()))


def test_cleaning_shuffles_its_rows_once(spark, tmp_path):
    core = FL.flights_core(spark, star(spark, tmp_path))
    both = [clean.clean_flights(core, widen=FL.widen), clean.clean_flights(FL.widen(core))]
    for out in both:
        # one exchange of the rows by bucket; the carried values (a row a bucket) have two
        assert plan(out).count("Exchange hashpartitioning(_bucket") == 2
    assert both[0].columns == both[1].columns
    a, b = (sorted(map(str, out.collect())) for out in both)
    assert a == b and a


def test_buckets_by_cells_equal_the_count_of_bounds_not_above(spark):
    rows = [(None,), (-5,), (0,), (0,), (7,), (7,), (8,), (900,), (10 ** 15,), (-10 ** 15,)] + [(i,) for i in range(40)]
    df = spark.createDataFrame(rows, "k long")
    bounds = [None if b == "{}" else int(b.split(":")[1][:-1]) for b in ordered.range_bounds(df, ["k"], 8)]
    for r in ordered.range_buckets(df, ["k"], 8).collect():
        at_most = [b for b in bounds if b is None or r["k"] is not None and b <= r["k"]]
        assert r[ordered.BUCKET] == len(at_most)
