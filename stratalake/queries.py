"""Queries over the driver's tables, one per operator or model."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import recast
from stratalake.constants import SALES_KEY
from stratalake.functions.calendar import utc_stamp
from stratalake.functions.numeric import to_number, to_strict_bigint
from stratalake.operators import quality
from stratalake.operators.clean import clean_sales, columns_report
from stratalake.operators.dedup import keep_first, merge, stack_by_name
from stratalake.operators.latest import newest, newest_day
from stratalake.operators.weather import check_documents, hourly_rows, require_valid_documents
from stratalake.plans import dims, facts, gold, jobs, silver, staging
from stratalake.session import scratch_path, settings
from stratalake.sinks import bronze, files, tables
from stratalake.sources.listing import PLACE
from stratalake.sources.sales_files import file_format, is_header, scan_sales
from stratalake.sources.synthetic import synthetic_sales
from stratalake.streaming.weather import start_merge

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# The stored hours end before OLD_END, the arriving hours begin at NEW_START, so a week overlaps.
OLD_END, NEW_START = "2024-01-21", "2024-01-15"
CSV_ORDER = (*recast.SALES_ORDER, "order_id")


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


# --- models -----------------------------------------------------------------------------


def _stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_orders(recast.orders(spark, sf_dir))


def _stg_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_weather(recast.hourly(spark, sf_dir))


@query
def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stg_orders(spark, sf_dir)


@query
def stg_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stg_weather(spark, sf_dir)


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_product(_stg_orders(spark, sf_dir))


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.by_date(dims.dim_date(_stg_weather(spark, sf_dir)))


@query
def dim_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.by_date(dims.dim_weather(_stg_weather(spark, sf_dir)))


@query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_sales(_stg_orders(spark, sf_dir))


@query
def fct_sales_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.best_first(facts.fct_sales_by_product(_stg_orders(spark, sf_dir)))


@query
def revenue_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One brand without any total; the mart puts it on top."""
    orders = _stg_orders(spark, sf_dir)
    total = F.when(F.col("product") != "Brand#13", F.col("total"))
    return facts.best_first(facts.fct_sales_by_product(orders.withColumn("total", total))).select("product", "revenue")


@query
def gold_weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six_places(gold.weather_daily(recast.hourly(spark, sf_dir)))


def _six_places(daily: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order, so averages are compared at six places."""
    return daily.withColumn("avg_temp_c", F.round("avg_temp_c", 6))


# --- cleaning, deduplication, merge ---------------------------------------------------------


@query
def sales_silver_total_computed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(recast.sales_text(spark, sf_dir, given_total=False))


@query
def sales_silver_total_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(recast.sales_text(spark, sf_dir, given_total=True))


def _one_of(key: str, variants: list[Column]) -> Column:
    """A different way to write a number for each remainder of the key."""
    return F.get(F.array(*variants), (F.col(key) % len(variants)).cast("int"))


@query
def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("string")
    text = _one_of("o_orderkey", [
        price, F.concat(F.lit(" "), price, F.lit(" ")), F.concat(price, F.lit("d")),
        F.lit("NaN"), F.lit("Infinity"), F.concat(F.lit("1,"), price),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("e3")), F.lit(""),
        F.concat(F.lit("-"), price), F.col("o_orderpriority"),
    ])
    return recast.table(spark, sf_dir, "orders").select("o_orderkey", to_number(text).alias("number"))


@query
def strict_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    text = _one_of("o_orderkey", [
        key, F.concat(F.lit(" "), key, F.lit(" ")), F.concat(key, F.lit(".9")),
        F.concat(key, F.lit("e2")), (F.col("o_orderkey") + 9007199254740993).cast("string"),
        F.concat(F.lit("-"), key, F.lit(".5")),
    ])
    return recast.table(spark, sf_dir, "orders").select(
        "o_orderkey", to_strict_bigint(text, "text").alias("whole")
    )


@query
def sales_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recast.sales(spark, sf_dir, *recast.SALES_ORDER)
    return keep_first(rows, SALES_KEY, recast.SALES_ORDER)


@query
def sales_union_missing_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = recast.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total")
    )
    return stack_by_name([recast.sales(spark, sf_dir), totals])


def _merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    hours = recast.hourly(spark, sf_dir)
    return (
        hours.filter(F.col("ts_utc") < F.lit(OLD_END).cast("timestamp_ntz")),
        hours.filter(F.col("ts_utc") >= F.lit(NEW_START).cast("timestamp_ntz"))
        .withColumn("temp_c", F.col("temp_c") + 1),
    )


@query
def weather_merge_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(*_merge_sides(spark, sf_dir), ["ts_utc"], ["temp_c"])


@query
def weather_merge_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(*_merge_sides(spark, sf_dir), ["ts_utc"], ["temp_c"], keep="last")


@query
def timestamp_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times to the stamps of raw file names, and through ISO text back to times."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    return recast.table(spark, sf_dir, "events").select(
        "event_id", utc_stamp(F.col("ts")).alias("stamp"), text.cast("timestamp_ntz").alias("minute")
    )


@query
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = recast.table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return newest_day(events, "ts")


@query
def latest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the largest order number."""
    lines = recast.table(spark, sf_dir, "lineitem")
    return newest(lines, "l_orderkey").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


# --- weather documents ----------------------------------------------------------------------


@query
def weather_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = recast.documents(recast.table(spark, sf_dir, "events"))
    return hourly_rows(require_valid_documents(documents)).drop("_at")


@query
def weather_doc_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lose the temperatures above 300, and all of `hourly` if the first humidity is low."""
    hourly = F.struct(
        F.col("hourly.time"),
        F.filter("hourly.temperature_2m", lambda t: t <= 300).alias("temperature_2m"),
        F.col("hourly.relative_humidity_2m"),
    )
    damaged = recast.documents(recast.table(spark, sf_dir, "events")).withColumn(
        "hourly", F.when(F.get("hourly.relative_humidity_2m", F.lit(0)) >= 20, hourly)
    )
    return check_documents(damaged, "document").fillna(0)


# --- data tests -----------------------------------------------------------------------------


@query
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _stg_orders(spark, sf_dir).select(
        "order_id",
        F.when(F.col("quantity") <= 45, F.col("product")).alias("product"),
        F.when(F.col("price") < 990, F.col("total")).alias("total"),
    )
    return quality.not_null_failures(orders, orders.columns)


@query
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [("orders", "o_orderkey"), ("orders", "o_custkey"), ("lineitem", "l_orderkey")]
    return stack_by_name([
        quality.unique_failures(recast.table(spark, sf_dir, name), column) for name, column in checks
    ])


@query
def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = recast.table(spark, sf_dir, "orders"), recast.table(spark, sf_dir, "lineitem")
    return stack_by_name([
        quality.reference_failures(lines, "l_orderkey", orders, "o_orderkey"),
        quality.reference_failures(orders, "o_orderkey", lines, "l_orderkey"),
    ])


@query
def test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, weather = _stg_orders(spark, sf_dir), _stg_weather(spark, sf_dir)
    return quality.run_tests({
        "stg_orders": orders,
        "stg_weather": weather,
        "dim_product": dims.dim_product(orders),
        "fact_sales": facts.fact_sales(orders),
        "fct_sales_by_product": facts.fct_sales_by_product(orders),
        "dim_date": dims.dim_date(weather),
        "dim_weather": dims.dim_weather(weather),
    })


@query
def required_columns_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = recast.sales_text(spark, sf_dir, given_total=True)
    return stack_by_name([
        columns_report(given.withColumnRenamed("price", "PRICE"), "with_total"),
        columns_report(given.drop("total"), "without_total"),
        columns_report(given.drop("price", "product"), "incomplete"),
    ])


# --- sources and sinks ----------------------------------------------------------------------


@query
def synthetic_sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = recast.table(spark, sf_dir, "orders")
    return synthetic_sales(orders, seed=7, id_column="o_orderkey")


@query
def roundtrip_seed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic rows written as a raw file, then scanned and cleaned."""
    folder = scratch_path(spark, "roundtrip_seed_csv")
    files.write_csv(synthetic_sales_rows(spark, sf_dir), f"{folder}/ventas_2024.csv")
    return clean_sales(scan_sales(spark, folder).frames[0], carry=PLACE).drop(*PLACE)


def _raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recast.sales(spark, sf_dir, *recast.SALES_ORDER)


@query
def sales_files_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw files with overlapping keys, one without `total`, one with upper-case names."""
    folder = scratch_path(spark, "sales_files_to_silver")
    rows = _raw_sales(spark, sf_dir)
    recast.write_raw_csv(rows.filter("l_linenumber <= 4"), folder, "ventas_2022.csv", CSV_ORDER)
    given = rows.filter("l_linenumber >= 3").withColumn("TOTAL", F.col("l_extendedprice"))
    recast.write_raw_csv(
        given.withColumnsRenamed({"order_id": "ORDER_ID", "price": "Price"}), folder,
        "ventas_2023.csv", (*recast.SALES_ORDER, "ORDER_ID"),
    )
    target = f"{folder}/silver"
    jobs.files_to_silver(spark, folder, target)
    return spark.read.parquet(target)


@query
def sales_part_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per product, by both ways to silver, from raw files in parts that swap their columns."""
    lake = scratch_path(spark, "sales_part_folders")
    seed = f"{lake}/seed"
    rows = recast.sales(spark, sf_dir, "l_linenumber")
    names = ["order_id", "product", "quantity", "price"]

    def write(some: DataFrame, columns: list[str], name: str) -> None:
        some.select(*columns).write.mode("append").option("header", True).csv(f"{seed}/{name}")

    write(rows.filter("l_linenumber >= 4"), names, "ventas_2021.csv")
    jobs.run_sales(spark, seed, lake)
    write(rows.filter("l_linenumber <= 2"), names, "ventas_2022.csv")
    write(rows.filter("l_linenumber between 3 and 4"), names[::-1], "ventas_2022.csv")
    landed = jobs.run_sales(spark, seed, lake)
    jobs.files_to_silver(spark, seed, f"{lake}/from_files")
    return stack_by_name([
        spark.read.parquet(path).groupBy("product").agg(
            F.count("*").alias("n_rows"),
            ((F.max("quantity") <= 50) & (F.min("price") >= 900)).alias("in_place"),
        ).withColumn("way", F.lit(way))
        for way, path in (("files", f"{lake}/from_files"), ("landed", landed))
    ])


def _told_apart(spark: SparkSession, sf_dir: str, mark: str) -> DataFrame:
    """Sales whose products also spell the line, so that rows with one key are alike."""
    own = ("l_linenumber", "l_suppkey", "l_partkey", "l_returnflag", "l_discount")
    parts = [*[F.col(c).cast("string") for c in own[:4]], F.col("quantity").cast("bigint").cast("string"), (F.col("l_discount") * 100).cast("int").cast("string")]
    return recast.sales(spark, sf_dir, *own).withColumn("product", F.concat(F.col("product"), F.lit(mark), F.concat_ws(" ", *parts)))


@query
def sales_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw file of many splits whose cells hold line breaks, quotes and commas, by both ways to silver."""
    lake = scratch_path(spark, "sales_line_breaks")
    rows = _told_apart(spark, sf_dir, '\n"",\n\n').select("order_id", "product", "quantity", "price")
    files.write_csv(rows, f"{lake}/seed/ventas_2024.csv")
    with settings(spark, spark__sql__files__maxPartitionBytes="1m"):
        jobs.files_to_silver(spark, f"{lake}/seed", f"{lake}/from_files", multi_line=True)
        landed = jobs.run_sales(spark, f"{lake}/seed", lake, multi_line=True)
    return stack_by_name([
        spark.read.parquet(path).withColumn("way", F.lit(way)) for way, path in (("files", f"{lake}/from_files"), ("landed", landed))
    ])


@query
def extra_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns beyond the sales file's own: numbers become numbers, what is text in one file is text in all."""
    lake = scratch_path(spark, "extra_column_types")
    rows = _told_apart(spark, sf_dir, " ")
    supplier = F.col("l_suppkey").cast("string")
    own = ("order_id", "product", "quantity", "price")
    files.write_csv(rows.filter("l_linenumber <= 3").select(
        *own, F.col("l_discount").alias("Discount"), supplier.alias("supplier"),
        F.when(F.col("l_linenumber") > 1, supplier).alias("mixed"), F.col("l_returnflag").alias("flag"),
    ), f"{lake}/ventas_2023.csv")
    files.write_csv(rows.filter("l_linenumber > 3").select(
        F.col("l_returnflag").alias("MIXED"), F.concat(supplier, F.lit("0" * 20)).alias("wide"), *own,
        F.when(F.col("l_linenumber") > 4, F.lit("NA")).otherwise(F.lit("1")).alias("discount"),
    ), f"{lake}/ventas_2024.csv")
    jobs.files_to_silver(spark, lake, f"{lake}/silver")
    return spark.read.parquet(f"{lake}/silver")


@query
def sales_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, check, silver, load, models, tests; the mart is read from its table."""
    lake = scratch_path(spark, "sales_end_to_end")
    recast.write_raw_csv(_raw_sales(spark, sf_dir), f"{lake}/seed", "ventas_2024.csv", CSV_ORDER)
    prefix = _unique_name(lake)
    models = jobs.sales_end_to_end(spark, f"{lake}/seed", lake, prefix=prefix)
    _forget_tables(spark, prefix)
    return models["fct_sales_by_product"]


@query
def weather_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed drops, each taken to silver, table and gold; the dimension is read from its table."""
    lake = scratch_path(spark, "weather_end_to_end")
    prefix = _unique_name(lake)
    for documents, moment in _drops(spark, sf_dir):
        bronze.land_weather(documents, f"{lake}/bronze/weather", moment)
        models = jobs.weather_end_to_end(spark, lake, prefix=prefix, multi_line=False)
    _forget_tables(spark, prefix)
    return models["dim_weather"]


@query
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed drops, merged by one streaming run after each."""
    lake = scratch_path(spark, "incremental_merge")
    for documents, moment in _drops(spark, sf_dir):
        bronze.land_weather(documents, f"{lake}/landing", moment)
        start_merge(
            spark, f"{lake}/landing", f"{lake}/silver", f"{lake}/checkpoint", multi_line=False
        ).awaitTermination()
    return spark.read.parquet(f"{lake}/silver").drop(files.DAY)


def _drops(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, datetime]]:
    """Documents of the stored and of the arriving hours, with their landing times."""
    events = recast.table(spark, sf_dir, "events")
    old = events.filter(F.col("ts") < F.lit(OLD_END).cast("timestamp_ntz"))
    new = events.filter(F.col("ts") >= F.lit(NEW_START).cast("timestamp_ntz"))
    return [
        (recast.documents(old).drop("document"), datetime(2024, 1, 21, tzinfo=timezone.utc)),
        (
            recast.documents(new.withColumn("value", F.col("value") + 1)).drop("document"),
            datetime(2024, 1, 31, tzinfo=timezone.utc),
        ),
    ]


def _unique_name(path: str) -> str:
    """A table name or prefix from a scratch path, which ends in a fresh id."""
    return "t_" + path.rpartition("-")[2]


def _forget_tables(spark: SparkSession, prefix: str) -> None:
    """Drops the catalog entries of one run; the files, which the result reads, stay."""
    for entry in spark.catalog.listTables(pattern=f"{prefix}*"):
        kind = "VIEW" if entry.tableType in ("VIEW", "TEMPORARY") else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {entry.name}")


@query
def truncate_append_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded twice under a view; the view shows the second load only."""
    location = scratch_path(spark, "truncate_append_count")
    table = _unique_name(location)
    orders = recast.orders(spark, sf_dir)
    tables.replace_contents(orders, table, location)
    view = f"{table}_view"
    tables.publish_view(spark, view, orders.columns, table)
    tables.replace_contents(orders.filter("quantity > 25"), table)
    counts = spark.table(view).groupBy("product").agg(F.count("*").alias("n_rows"))
    _forget_tables(spark, table)
    return counts


@query
def model_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of the built models as another session finds them, with the models' rows."""
    lake = scratch_path(spark, "model_descriptions")
    prefix = _unique_name(lake)
    tables.replace_contents(recast.orders(spark, sf_dir), f"{prefix}_orders", f"{lake}/orders")
    jobs.build_models(
        {"orders": spark.table(f"{prefix}_orders")}, prefix=f"{prefix}_", folder=f"{lake}/models", loaded={"orders": f"{prefix}_orders"}
    )
    other, found = spark.newSession(), []
    for name in ("stg_orders", "fct_sales_by_product"):
        described = other.sql(f"DESCRIBE EXTENDED {prefix}_{name}").filter("col_name = 'Comment'").first()["data_type"]
        rows = spark.table(f"{prefix}_{name}").agg(F.count("*").alias("n_rows"))
        found.append(rows.select(F.lit(name).alias("model"), F.lit(described).alias("description"), "n_rows"))
    return _kept(stack_by_name(found), lake, prefix)


def _kept(df: DataFrame, lake: str, prefix: str) -> DataFrame:
    """The rows, written before the catalog entries that they came from go."""
    spark, path = df.sparkSession, f"{lake}/result"
    files.write_silver(df, path)
    _forget_tables(spark, prefix)
    return spark.read.parquet(path)


@query
def refused_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that the jobs must not take, next to one that they take: (input, refusal, n_rows in silver)."""
    lake = scratch_path(spark, "refused_inputs")
    rows = recast.sales(spark, sf_dir)
    good, short = f"{lake}/good", f"{lake}/short"
    files.write_csv(rows, f"{good}/ventas_2024.csv")
    files.write_csv(rows.drop("price"), f"{short}/ventas_2024.csv")
    files.write_csv(rows, f"{lake}/odd/other_2024.csv")
    attempts = {
        "good": lambda: jobs.files_to_silver(spark, good, f"{lake}/silver/good"),
        "no price": lambda: jobs.files_to_silver(spark, short, f"{lake}/silver/short"),
        "no sales file": lambda: jobs.files_to_silver(spark, f"{lake}/odd", f"{lake}/silver/odd"),
        "unknown format": lambda: file_format("ventas_2024.ods"),
        "no silver": lambda: jobs.load(spark, f"{lake}/silver/none", "never_loaded"),
    }
    found = []
    for name, attempt in attempts.items():
        try:
            attempt()
            refusal = "none"
        except (ValueError, FileNotFoundError, AnalysisException) as error:
            refusal = type(error).__name__
        taken = spark.read.parquet(f"{lake}/silver/good") if name == "good" else rows.limit(0)
        found.append(taken.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("input"), F.lit(refusal).alias("refusal"), "n_rows"))
    return stack_by_name(found)


@query
def roundtrip_csv_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip_csv_gold")
    files.write_one_csv(gold.weather_daily(recast.hourly(spark, sf_dir)), path, ["date"])
    schema = "date DATE, avg_temp_c DOUBLE, min_temp_c DOUBLE, max_temp_c DOUBLE"
    return _six_places(spark.read.schema(schema).option("header", True).csv(path))


@query
def roundtrip_bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines as landed, without header lines."""
    lake = scratch_path(spark, "roundtrip_bronze_lineage")
    rows = _raw_sales(spark, sf_dir)
    recast.write_raw_csv(rows, f"{lake}/seed", "ventas_2024.csv", CSV_ORDER)
    bronze.land_sales_file(spark, f"{lake}/seed", f"{lake}/bronze")
    lines, parts = bronze.landed_lines(spark, f"{lake}/bronze"), bronze.landed_parts(spark, f"{lake}/bronze")
    return lines.join(parts.select("_file", "skip"), "_file").filter(~is_header()).select("raw_name", "line")


@query
def roundtrip_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days written, then the days of the arriving side written anew."""
    path = scratch_path(spark, "roundtrip_dynamic_overwrite")
    files.replace_days(recast.hourly(spark, sf_dir), path, "ts_utc")
    files.replace_days(_merge_sides(spark, sf_dir)[1], path, "ts_utc")
    return spark.read.parquet(path).drop(files.DAY)
