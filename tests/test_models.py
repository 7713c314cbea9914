"""Models, data tests, tables and plans."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from stratalake import recast
from stratalake.operators import quality
from stratalake.operators.latest import newest_day
from stratalake.plans import dims, facts, jobs, staging
from stratalake.session import scratch_path, sized_shuffles
from stratalake.sinks import files, tables
from stratalake.sources.tables import read_silver, read_table

SF_DIR = "/root/testdata/sf0.001"
ORDERS = "order_id bigint, product string, quantity bigint, price double, total double"
HOURLY = "ts_utc timestamp_ntz, temp_c double, rh_pct double, lat double, lon double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def weather(spark, *times):
    return staging.stg_weather(spark.createDataFrame([(t, 1.0, 50.0, 0.0, 0.0) for t in times], HOURLY))


def test_staging_types(spark):
    orders = staging.stg_orders(spark.createDataFrame([(1, "A", 2, 10.555, 21.11)], ORDERS))
    assert [t for _, t in orders.dtypes] == ["int", "string", "int", "decimal(10,2)", "decimal(12,2)"]
    assert orders.first()["price"] == Decimal("10.56")
    stg = staging.stg_weather(spark.createDataFrame([(datetime(2025, 8, 1), 1.239, 2.5, 0.0, 0.0)], HOURLY))
    assert [t for _, t in stg.dtypes][:3] == ["timestamp_ntz", "decimal(5,2)", "int"]
    assert (stg.first()["temp_c"], stg.first()["rh_pct"]) == (Decimal("1.24"), 2)


@pytest.mark.parametrize("row", [(1, "A", 1, 123456789.555, 1.0), (2**31, "A", 1, 1.0, 1.0)])
def test_staging_overflow_fails(spark, row):
    with pytest.raises(PySparkException):
        staging.stg_orders(spark.createDataFrame([row], ORDERS)).collect()


def test_calendar_fills_gaps_and_weather_does_not(spark):
    stg = weather(spark, datetime(2025, 8, 1, 5), datetime(2025, 8, 3, 23), None)
    assert [r["date_key"] for r in dims.dim_date(stg).collect()] == [20250801, 20250802, 20250803]
    assert [r["date_key"] for r in dims.dim_weather(stg).collect()] == [20250801, 20250803, None]
    assert dims.dim_date(weather(spark)).count() == 0


def test_product_without_totals_comes_first(spark):
    rows = [(1, "A", 1, 1.0, 5.0), (2, "B", 1, 1.0, None), (3, "C", 1, 1.0, 9.0), (4, None, 2, None, 1.0)]
    mart = facts.best_first(facts.fct_sales_by_product(staging.stg_orders(spark.createDataFrame(rows, ORDERS))))
    assert [r["product"] for r in mart.collect()] == ["B", "C", "A", None]
    assert mart.filter("product is null").first()["avg_price"] is None


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "x int")
    assert quality.unique_failures(df, "x").first()["failures"] == 1
    assert quality.not_null_failures(df, ["x"]).first()["failures"] == 2


def test_orphans_are_counted_by_row(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (8,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "pk int")
    assert quality.reference_failures(child, "fk", parent, "pk").first()["failures"] == 3
    assert quality.reference_failures(child.filter("fk = 1"), "fk", parent, "pk").first()["failures"] == 0


def test_failing_test_stops_the_run(spark):
    orders = spark.createDataFrame([(1, None, 1, 1.0, 1.0)], ORDERS)
    with pytest.raises(AssertionError, match="stg_orders.product not_null: 1"):
        quality.require_passed(quality.run_tests({"stg_orders": staging.stg_orders(orders)}))
    with pytest.raises(ValueError):
        quality.run_tests({"stg_weather": weather(spark)})


def test_declared_tests_refer_to_models():
    assert set(quality.DECLARED_TESTS) == set(jobs.MODELS)
    assert sum(len(t.not_null) for t in quality.DECLARED_TESTS.values()) == 15
    assert sum(len(t.unique) for t in quality.DECLARED_TESTS.values()) == 4


def test_table_reload_keeps_views(spark, tmp_path):
    """Views by name follow the table; a frame, and a session view made from one, keep the rows that they were made on."""
    table, location = "reload_orders", str(tmp_path / "reload_orders")
    first = spark.createDataFrame([(1, "A", 1, 1.0, 1.0), (2, "B", 1, 1.0, 1.0)], ORDERS)
    assert tables.replace_contents(first, table, location) == 2
    tables.publish_view(spark, "reload_stg", staging.orders_columns(spark.table(table)), table)
    tables.publish(staging.stg_orders(read_table(spark, table)), "reload_session")
    second = spark.createDataFrame([(5.0, 1, 3, "C", 1.0)], "total double, order_id bigint, quantity bigint, product string, price double")
    for rows, product in ((second, "C"), (second.withColumn("product", F.lit("D")), "D"), (second, "C")):
        assert tables.replace_contents(rows, table) == 1
        assert [(r["product"], r["total"]) for r in spark.table("reload_stg").collect()] == [(product, Decimal("5.00"))]
        assert [(r["product"], r["total"]) for r in spark.newSession().table("reload_stg").collect()] == [(product, Decimal("5.00"))]
    assert sorted(r["product"] for r in spark.table("reload_session").collect()) == ["A", "B"]
    with pytest.raises(ValueError, match="columns of"):
        tables.replace_contents(first.drop("price"), table)


def test_a_load_shows_nothing_until_it_is_complete(spark, tmp_path, monkeypatch):
    """Between write and switch readers see the old rows, and a failed load changes nothing."""
    table, location = "switched_orders", str(tmp_path / "switched")
    first = spark.createDataFrame([(1, "A", 1, 1.0, 1.0), (2, "B", 1, 1.0, 1.0)], ORDERS)
    tables.replace_contents(first, table, location)
    seen, other = [], tables._other_folder

    def beside(folder):
        seen.append(spark.newSession().table(table).count())
        return other(folder)

    monkeypatch.setattr(tables, "_other_folder", beside)
    broken = first.withColumn("price", F.when(F.col("order_id") == 1, F.col("price")).otherwise(F.raise_error("no price").cast("double")))
    with pytest.raises(PySparkException, match="no price"):
        tables.replace_contents(broken, table)
    assert spark.newSession().table(table).count() == 2
    assert tables.replace_contents(first.filter("order_id = 1"), table) == 1 and spark.table(table).count() == 1
    assert seen == [2, 2]


def test_counts_come_from_the_write(spark, tmp_path, monkeypatch):
    """Nothing is counted after a load, and a mismatch still stops it."""
    orders = spark.createDataFrame([(i, "A", 1, 1.0, 1.0) for i in range(50)], ORDERS)
    n = files.write_silver(orders, str(tmp_path / "silver"))
    assert n == 50 and jobs.load(spark, str(tmp_path / "silver"), "counted_orders", str(tmp_path / "table"), n) == 50
    monkeypatch.setattr(DataFrame, "count", lambda self: pytest.fail("rows are counted once more"))
    assert jobs.load(spark, str(tmp_path / "silver"), "counted_orders", None, 50) == 50
    for expected in (49, 51):
        with pytest.raises(RuntimeError, match=f"50 rows were loaded into counted_orders, silver holds {expected}"):
            jobs.load(spark, str(tmp_path / "silver"), "counted_orders", None, expected)


def test_publish_kinds(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        tables.publish(df, "published", "table", "it's a \\ test", str(tmp_path / "published"))
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED published").collect()}
    assert described["Comment"] == "it's a \\ test" and spark.table("published").count() == 3
    with pytest.raises(ValueError):
        tables.publish(df, "published", "cube")


def test_sales_end_to_end(spark, tmp_path):
    (tmp_path / "seed").mkdir()
    for year in (2023, 2024):
        (tmp_path / "seed" / f"ventas_{year}.csv").write_text(
            f"order_id,product,quantity,price\n1,A,2,10.5\n1,A,3,11\n2,B,1,{year}\n")
        models = jobs.sales_end_to_end(spark, str(tmp_path / "seed"), str(tmp_path / "lake"), prefix="sales_e2e")
    assert set(models) == {"stg_orders", "dim_product", "fact_sales", "fct_sales_by_product"}
    assert [(r["product"], r["n_orders"], r["qty"], float(r["revenue"])) for r in
            models["fct_sales_by_product"].orderBy("product").collect()] == [("A", 1, 2, 21.0), ("B", 1, 1, 2023.0)]
    assert models["fact_sales"].join(models["dim_product"], "product_key").count() == 2
    other = spark.newSession()
    assert other.table("sales_e2e_stg_orders").count() == 2 and not models["stg_orders"].isStreaming
    described = {name: next(r["data_type"] for r in other.sql(f"DESCRIBE EXTENDED sales_e2e_{name}").collect() if r["col_name"] == "Comment")
                 for name in ("stg_orders", "fct_sales_by_product")}
    assert described == {"stg_orders": "Staging: the orders table with set types", "fct_sales_by_product": "Facts: sales aggregated per product"}


def test_stored_models_are_not_sorted(spark):
    orders = staging.stg_orders(recast.orders(spark, SF_DIR))
    hours = staging.stg_weather(recast.hourly(spark, SF_DIR))
    for model in (facts.fct_sales_by_product(orders), dims.dim_weather(hours), dims.dim_date(hours)):
        assert "rangepartitioning" not in plan(model)


def test_one_pass_over_each_tested_model(spark):
    """One scan per model, and one more for the parent of a reference."""
    orders = spark.range(100).selectExpr("cast(id as int) order_id", "concat('p', id % 5) product", "1 quantity", "2.0 price", "3.0 total")
    orders.write.mode("overwrite").saveAsTable("tested_orders")
    staged = staging.stg_orders(spark.table("tested_orders"))
    models = {"stg_orders": staged, "fact_sales": facts.fact_sales(staged), "dim_product": dims.dim_product(staged),
              "fct_sales_by_product": facts.fct_sales_by_product(staged)}
    report = quality.run_tests(models)
    assert plan(report).count("FileScan") == len(models) + 1
    quality.require_passed(report)
    broken = {**models, "fact_sales": models["fact_sales"].withColumn("product_key", F.when(F.col("order_id") > 9, "none").when(F.col("order_id") > 3, F.col("product_key")))}
    found = {(r["model"], r["column"], r["test"]): r["failures"] for r in quality.run_tests(broken).collect()}
    assert found["fact_sales", "product_key", "not_null"] == 4 and found["fact_sales", "product_key", "relationships"] == 90


def test_several_keys_in_one_pass(spark, tmp_path):
    """Three unique columns, two of them references, one scan of the model; the same counts as by single tests."""
    rows = [(i % 7 or None, f"k{i % 11}", i, None if i % 5 else 1.0) for i in range(60)] + [(3, None, None, 1.0), (99, "k1", 59, None)]
    spark.createDataFrame(rows, "a int, b string, c long, d double").write.parquet(str(tmp_path / "m"))
    model = spark.read.parquet(str(tmp_path / "m"))
    parents = {"p": spark.createDataFrame([(i,) for i in range(6)], "a int"), "q": spark.createDataFrame([("k1",), ("k2",), (None,)], "b string")}
    declared = {"m": quality.ModelTests(
        not_null=("a", "b", "c", "d"), unique=("a", "b", "c"), references=(quality.Reference("a", "p", "a"), quality.Reference("b", "q", "b"))
    )}
    report = quality.run_tests({"m": model, **parents}, declared)
    assert plan(report).count("FileScan parquet") == 1
    got = {(r["column"], r["test"]): r["failures"] for r in report.collect()}
    want = [quality.not_null_failures(model, declared["m"].not_null), *[quality.unique_failures(model, c) for c in "abc"],
            quality.reference_failures(model, "a", parents["p"], "a"), quality.reference_failures(model, "b", parents["q"], "b")]
    assert got == {(r["column"], r["test"]): r["failures"] for df in want for r in df.collect()} and len(got) == 9


def test_empty_models_pass(spark):
    empty = staging.stg_orders(spark.createDataFrame([], ORDERS))
    models = {"stg_orders": empty, "dim_product": dims.dim_product(empty), "fact_sales": facts.fact_sales(empty)}
    assert {r["failures"] for r in quality.run_tests(models).collect()} == {0}


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.shuffle.partitions"

    def partitions(n_bytes):
        with sized_shuffles(spark, n_bytes):
            return spark.conf.get(key)

    assert [partitions(n) for n in (0, 10 * 2**30, 10**15)] == ["8", "40", str(-(-10**15 // 2**28))]
    assert spark.conf.get(key) == "8"


def test_ansi_is_required(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            jobs.build_models({"orders": spark.createDataFrame([], ORDERS)})
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_missing_silver_fails_before_load(spark, tmp_path):
    with pytest.raises(PySparkException):
        read_silver(spark, str(tmp_path / "none"))


def test_scratch_path_needs_a_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(base)

    class Bare:
        conf = {"spark.sql.warehouse.dir": "/warehouse"}

    assert scratch_path(Bare, "x").startswith("/warehouse/_scratch/x-")


def test_plans_prune_and_do_not_shuffle_needlessly(spark):
    lines = recast.table(spark, SF_DIR, "lineitem")
    flat = facts.fact_sales(staging.stg_orders(lines.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("product"),
        F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("price"), F.col("l_tax").alias("total"))))
    assert "Exchange" not in plan(flat) and "l_shipdate" not in plan(flat)
    mart = facts.fct_sales_by_product(staging.stg_orders(recast.orders(spark, SF_DIR)))
    assert "partial_sum" in plan(mart) and "l_extendedprice" not in plan(mart)
    assert plan(mart).count("Exchange hashpartitioning") == 1
    latest = newest_day(recast.table(spark, SF_DIR, "events").select("ts", "value"), "ts")
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in plan(latest)
    assert "Exchange" not in plan(staging.stg_weather(recast.hourly(spark, SF_DIR)))


def test_whole_stage_codegen_has_no_python(spark):
    for build in (facts.fct_sales_by_product, dims.dim_product, facts.fact_sales):
        text = plan(build(staging.stg_orders(recast.orders(spark, SF_DIR))))
        assert "Python" not in text and "Pandas" not in text
