"""Weather documents to silver, merge, gold and the stream."""

import json
from datetime import date, datetime, timedelta, timezone

import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from stratalake.operators.dedup import merge
from stratalake.operators.weather import check_documents, hourly_rows, require_valid_documents
from stratalake.plans import daily, dims, gold, jobs, staging
from stratalake.plans.silver import merge_weather
from stratalake.sinks import files
from stratalake.sinks.bronze import land_weather, weather_file_name
from stratalake.sources.weather_files import newest_weather_file, read_documents
from stratalake.streaming.weather import start_merge

HOURLY = "ts_utc timestamp_ntz, temp_c double, rh_pct double, lat double, lon double"


def document(times, temperatures, humidity=None, **more):
    humidity = [50] * len(times) if humidity is None else humidity
    return {"latitude": -34.5, "longitude": -58.5, "unit": "x", **more,
            "hourly": {"time": times, "temperature_2m": temperatures, "relative_humidity_2m": humidity}}


def drop(folder, stamp, doc):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"weather_{stamp}.json").write_text(json.dumps(doc, indent=1))


def stored(spark, path):
    df = spark.read.parquet(str(path)).select("ts_utc", "temp_c").orderBy("ts_utc")
    return [(r[0].strftime("%d %H") if r[0] else None, r[1]) for r in df.collect()]


def hours(spark, *pairs):
    return spark.createDataFrame(
        [(t and datetime(2025, 8, 1) + timedelta(days=t[0] - 1, hours=t[1]), v, 1.0, 0.0, 0.0) for t, v in pairs], HOURLY)


def test_newest_document_to_rows(spark, tmp_path):
    drop(tmp_path, "20250801T000000Z", document(["2025-08-01T00:00"], [1.0]))
    drop(tmp_path, "20250802T000000Z", document(["2025-08-01T23:00", "2025-08-02T00:00"], [10.1, None], [40, None]))
    name = newest_weather_file(spark, str(tmp_path))
    assert name == "weather_20250802T000000Z.json"
    got = hourly_rows(read_documents(spark, str(tmp_path), name)).drop("_at").collect()
    assert [tuple(r) for r in got] == [
        (datetime(2025, 8, 1, 23), 10.1, 40.0, -34.5, -58.5), (datetime(2025, 8, 2), None, None, -34.5, -58.5)]
    assert read_documents(spark, str(tmp_path)).count() == 2


def test_missing_coordinates_are_null(spark, tmp_path):
    doc = document(["2025-08-01T00:00"], [1.0])
    del doc["latitude"]
    drop(tmp_path, "1", doc)
    assert hourly_rows(read_documents(spark, str(tmp_path))).first()["lat"] is None


@pytest.mark.parametrize("damage", [
    lambda d: d.pop("hourly"), lambda d: d["hourly"].pop("time"),
    lambda d: d["hourly"].pop("relative_humidity_2m"), lambda d: d["hourly"]["temperature_2m"].pop(),
    lambda d: d["hourly"].update(temperature_2m=None),
])
def test_malformed_document(spark, tmp_path, damage):
    doc = document(["2025-08-01T00:00", "2025-08-01T01:00"], [1.0, 2.0])
    drop(tmp_path, "1", doc)
    damage(doc)
    drop(tmp_path, "2", doc)
    documents = read_documents(spark, str(tmp_path))
    verdicts = check_documents(documents, "_file").orderBy("_file").collect()
    assert [r["is_valid"] for r in verdicts] == [True, False]
    with pytest.raises(PySparkException, match="equally long"):
        merge_weather(documents, str(tmp_path / "out"))


def test_bad_time_or_number_fails(spark, tmp_path):
    drop(tmp_path / "a", "1", document(["soon"], [1.0]))
    drop(tmp_path / "b", "1", document(["2025-08-01T00:00"], ["warm"]))
    for folder in ("a", "b"):
        with pytest.raises((PySparkException, Py4JJavaError)):
            merge_weather(read_documents(spark, str(tmp_path / folder)), str(tmp_path / "out"))


def test_merge_first_and_last(spark):
    old = hours(spark, ((1, 1), 1.0), (None, 7.0))
    new = hours(spark, ((1, 1), 2.0), ((1, 2), 3.0), ((1, 2), 4.0), (None, 8.0)).withColumn("_at", F.col("temp_c"))

    def merged(**options):
        df = merge(old, new, ["ts_utc"], ["_at"], **options)
        return [r["temp_c"] for r in df.orderBy("ts_utc").collect()]

    assert merged() == [7.0, 1.0, 3.0]
    assert merged(keep="last") == [8.0, 2.0, 4.0]
    with pytest.raises(ValueError):
        merged(keep="any")


@pytest.mark.parametrize("keep, expected", [
    ("first", [(None, 9.0), ("01 01", 1.0), ("01 02", 2.0), ("02 05", 5.0), ("03 00", 3.0)]),
    ("last", [(None, 8.0), ("01 01", 1.0), ("01 02", -2.0), ("02 05", 5.0), ("03 00", 3.0)]),
])
def test_merge_into_store(spark, tmp_path, keep, expected):
    path = str(tmp_path / "silver")
    files.merge_hourly(hours(spark, ((1, 1), 1.0), ((1, 2), 2.0), (None, 9.0)), path, keep=keep)
    batch = hours(spark, ((1, 2), -2.0), ((3, 0), 3.0), (None, 8.0))
    for _ in range(2):  # the second run of the same batch changes nothing
        files.merge_hourly(batch, path, keep=keep)
        files.merge_hourly(hours(spark, ((2, 5), 5.0)), path, keep=keep)
    assert stored(spark, path) == expected


@pytest.mark.parametrize("keep, expected", [("first", 2.0), ("last", 4.0)])
def test_repeated_hour_inside_a_batch(spark, tmp_path, keep, expected):
    doc = document(["2025-08-01T00:00"] * 3, [2.0, 3.0, 4.0])
    drop(tmp_path / "in", "1", doc)
    merge_weather(read_documents(spark, str(tmp_path / "in")), str(tmp_path / "silver"), keep)
    assert stored(spark, tmp_path / "silver") == [("01 00", expected)]


def test_untouched_days_keep_their_files(spark, tmp_path):
    path = tmp_path / "silver"
    files.replace_days(hours(spark, ((1, 1), 1.0), ((2, 1), 2.0), ((2, 0), 1.5)), str(path), "ts_utc")
    before = {p.name for p in path.glob("ts_date=2025-08-01/*.parquet")}
    files.replace_days(hours(spark, ((2, 3), 4.0)), str(path), "ts_utc")
    assert {p.name for p in path.glob("ts_date=2025-08-01/*.parquet")} == before
    assert stored(spark, path) == [("01 01", 1.0), ("02 03", 4.0)]


def test_first_wins_appends_and_reads_touched_days_only(spark, tmp_path):
    path = tmp_path / "silver"
    files.merge_hourly(hours(spark, ((1, 1), 1.0), ((2, 1), 2.0)), str(path))
    before = {str(p) for p in path.rglob("*.parquet")}
    files.merge_hourly(hours(spark, ((2, 1), 9.0), ((2, 2), 3.0)), str(path))
    assert before < {str(p) for p in path.rglob("*.parquet")}
    touched = files.read_hourly(spark, str(path)).filter(files.on_days(F.col(files.DAY), [date(2025, 8, 2), None]))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert sorted(r["temp_c"] for r in touched.collect()) == [2.0, 3.0]


def test_compact_days(spark, tmp_path):
    path = tmp_path / "silver"
    for h in (5, 3, 1):
        files.merge_hourly(hours(spark, ((1, h), float(h)), ((2, h), 0.0)), str(path))
    assert len(list(path.glob("ts_date=2025-08-01/*.parquet"))) == 3
    files.compact_days(spark, str(path), [date(2025, 8, 1)])
    kept = list(path.glob("ts_date=2025-08-01/*.parquet"))
    assert pd.concat([pd.read_parquet(p) for p in sorted(kept)])["temp_c"].tolist() == [1.0, 3.0, 5.0]
    assert len(kept) < 3 and len(list(path.glob("ts_date=2025-08-02/*.parquet"))) == 3


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 99)), max_size=10), min_size=1, max_size=3))
def test_merge_agrees_with_pandas(spark, tmp_path_factory, batches):
    path = str(tmp_path_factory.mktemp("store") / "silver")
    expected = None
    for batch in batches:
        df = pd.DataFrame(batch, columns=["h", "v"]).drop_duplicates("h")
        expected = df if expected is None else pd.concat([expected, df]).drop_duplicates("h")
        files.merge_hourly(hours(spark, *[((1 + h // 24, h % 24), float(v)) for h, v in df.values.tolist()]), path)
    expected = expected.sort_values("h")
    got = files.read_hourly(spark, path)
    assert (stored(spark, path) if got is not None else []) == [
        (f"{1 + h // 24:02d} {h % 24:02d}", float(v)) for h, v in expected.values.tolist()]


def test_gold_file(spark, tmp_path):
    source = hours(spark, ((2, 0), 4.0), ((1, 5), 1.0), ((1, 6), 2.0), ((1, 7), None), ((3, 0), float("nan")), (None, 5.0))
    path = tmp_path / "gold.csv"
    files.write_one_csv(gold.weather_daily(source), str(path), ["date"])
    parts = list(path.glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text() == (
        "date,avg_temp_c,min_temp_c,max_temp_c\n2025-08-01,1.5,1.0,2.0\n2025-08-02,4.0,4.0,4.0\n2025-08-03,,,\n")


def test_file_name_and_landing(spark, tmp_path):
    moment = datetime(2025, 8, 1, 3, 0, 9, tzinfo=timezone.utc)
    assert weather_file_name(moment) == "weather_20250801T030009Z.json"
    documents = spark.createDataFrame(
        [(1.0, 2.0, (["2025-08-01T00:00"], [1.5], [60.0]))],
        "latitude double, longitude double, hourly struct<time: array<string>, "
        "temperature_2m: array<double>, relative_humidity_2m: array<double>>")
    name = land_weather(documents, str(tmp_path), moment)
    assert newest_weather_file(spark, str(tmp_path)) == name
    got = hourly_rows(require_valid_documents(read_documents(spark, str(tmp_path), name)))
    assert got.first()["temp_c"] == 1.5


def stream(spark, tmp_path, **options):
    start_merge(spark, str(tmp_path / "in"), str(tmp_path / "silver"), str(tmp_path / "check"), **options
                ).awaitTermination()


def test_stream_takes_new_files_only(spark, tmp_path):
    drop(tmp_path / "in", "20250801T000000Z", document(["2025-08-01T00:00", "2025-08-01T01:00"], [1.0, 2.0]))
    stream(spark, tmp_path)
    # Two files between runs, and an hour that comes late: nothing is skipped.
    drop(tmp_path / "in", "20250801T030000Z", document(["2025-08-01T01:00", "2025-08-01T03:00"], [9.0, 3.0]))
    drop(tmp_path / "in", "20250801T060000Z", document(["2025-07-31T00:00", "2025-08-01T03:00"], [0.5, 9.0]))
    stream(spark, tmp_path)
    expected = [("31 00", 0.5), ("01 00", 1.0), ("01 01", 2.0), ("01 03", 3.0)]
    assert stored(spark, tmp_path / "silver") == expected
    stream(spark, tmp_path)
    assert stored(spark, tmp_path / "silver") == expected


def test_stream_survives_a_repeated_batch(spark, tmp_path):
    """A fresh checkpoint sends every file again; the store does not change."""
    for i in range(3):
        drop(tmp_path / "in", f"2025080{i + 1}T000000Z", document([f"2025-08-01T0{i}:00", "2025-08-01T09:00"], [float(i), 9.0 + i]))
    stream(spark, tmp_path, max_files=1)
    once = stored(spark, tmp_path / "silver")
    start_merge(spark, str(tmp_path / "in"), str(tmp_path / "silver"), str(tmp_path / "check2")).awaitTermination()
    assert stored(spark, tmp_path / "silver") == once and len(once) == 4


def test_stream_stops_at_a_malformed_document(spark, tmp_path):
    drop(tmp_path / "in", "1", document(["2025-08-01T00:00"], []))
    with pytest.raises(StreamingQueryException):
        stream(spark, tmp_path)


def test_weather_end_to_end(spark, tmp_path):
    lake = tmp_path / "lake"
    for day, temperature in ((1, 1.0), (3, 3.0)):
        drop(lake / "bronze" / "weather", f"2025080{day}T000000Z",
             document(["2025-08-01T00:00", f"2025-08-0{day}T01:00"], [temperature, 2.0], [40, 41]))
        models = jobs.weather_end_to_end(spark, str(lake), prefix="e2e")
    assert [(r["date_key"], float(r["avg_temp_c"])) for r in models["dim_weather"].orderBy("date").collect()] == [
        (20250801, 1.5), (20250803, 2.0)]
    assert models["dim_date"].count() == 3
    assert spark.table("e2e_weather_hourly").count() == 3


def test_only_touched_days_are_loaded(spark, tmp_path):
    """After a second drop, files of other days keep their names and a stored view shows all rows."""
    lake, table = str(tmp_path / "lake"), "touched_weather_hourly"

    def drop(day_hours, moment):
        docs = spark.createDataFrame([(1.0, 2.0, ([f"2025-08-{d:02d}T{h:02d}:00" for d, h in day_hours], [float(h) for _, h in day_hours],
                                                  [50 for _ in day_hours]))],
                                     "latitude double, longitude double, hourly struct<time: array<string>, temperature_2m: array<double>, "
                                     "relative_humidity_2m: array<int>>")
        land_weather(docs, f"{lake}/bronze/weather", datetime(2025, 9, moment, tzinfo=timezone.utc))
        return jobs.weather_end_to_end(spark, lake, prefix="touched", multi_line=False)

    def names(day):
        return sorted(p.name for p in (tmp_path / "lake" / "warehouse" / "weather_hourly" / f"ts_date=2025-08-{day:02d}").glob("*.parquet"))

    drop([(1, 0), (1, 1), (2, 0)], 1)
    before = {d: names(d) for d in (1, 2)}
    drop([(2, 0), (2, 5), (3, 7)], 2)
    assert names(1) == before[1] and names(2) != before[2] and names(3)
    assert spark.table(table).count() == 5 and spark.newSession().table("touched_stg_weather").count() == 5
    assert jobs.load_days(spark, f"{lake}/silver/weather/weather_hourly.parquet", table, None) == 5


def test_batches_size_their_shuffles_and_keep_nothing(spark, tmp_path, monkeypatch):
    from stratalake.streaming import weather as stream

    seen = []

    def spy(documents, path, keep):
        seen.append((spark.conf.get("spark.sql.shuffle.partitions"), documents.storageLevel.useDisk, documents.columns))

    monkeypatch.setattr(stream, "merge_weather", spy)
    monkeypatch.setattr(stream, "total_bytes", lambda files: files.agg(F.sum("length")).first()[0] * 2**30)
    (tmp_path / "in").mkdir()
    text = '{"latitude":1.0,"longitude":2.0,"hourly":{"time":["2025-08-01T00:00"],"temperature_2m":[1.0],"relative_humidity_2m":[5.0]}}'
    (tmp_path / "in" / "weather_20250801T000000Z.json").write_text(text)
    start_merge(spark, str(tmp_path / "in"), str(tmp_path / "silver"), str(tmp_path / "check")).awaitTermination()
    assert [int(n) for n, _, _ in seen] == [len(text) * 4] and "_bytes" not in seen[0][2]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_merge_keeps_the_first_of_equal_new_hours(spark):
    old = spark.createDataFrame([(1, 1.0, 0)], "k int, v double, at int")
    new = spark.createDataFrame([(2, 9.0, 2), (2, 7.0, 1), (1, 5.0, 1)], "k int, v double, at int").repartition(3)
    rows = {r["k"]: r["v"] for r in merge(old, new, ["k"], ["at"]).collect()}
    assert rows == {1: 1.0, 2: 7.0}
    assert {r["k"]: r["v"] for r in merge(old, new, ["k"], ["at"], keep="last").collect()} == {1: 5.0, 2: 9.0}


def test_partial_results_give_what_the_hours_give(spark, tmp_path):
    """Gold file and dimensions from stored partial results, after drops that touch some days, against the whole history."""
    path, parts_path = str(tmp_path / "silver"), str(tmp_path / "parts")
    batches = [
        [((1, 0), 1.5), ((1, 1), -2.25), ((2, 3), None), ((3, 5), float("nan")), (None, 5.0)], [((1, 1), 9.0), ((2, 4), 7.0), ((9, 0), 3.0)],
        [(None, 6.0), ((40, 1), 2.0)], [],
    ]
    for batch in batches:
        days = files.merge_hourly(hours(spark, *batch), path)
        parts = daily.update_parts(spark, path, parts_path, days)
        hourly = files.read_hourly(spark, path)
        assert daily.rows_of(parts, None) == hourly.count()
        assert daily.rows_of(parts, days) == (hourly.count() if days is None else hourly.filter(files.on_days(F.col(files.DAY), days)).count() if days else 0)
        assert [tuple(r) for r in daily.weather_daily(parts).collect()] == [tuple(r) for r in gold.weather_daily(hourly).collect()]
        finite = hourly.filter("temp_c is null or not isnan(temp_c)")
        for own, whole in ((daily.dim_weather, dims.dim_weather), (daily.dim_date, dims.dim_date)):
            got = own(daily.day_parts(finite) if own is daily.dim_weather else parts)
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole(staging.stg_weather(finite if own is daily.dim_weather else hourly)).collect()), key=str)
            assert got.dtypes == whole(staging.stg_weather(hourly)).dtypes


def test_untouched_days_are_not_read_for_gold(spark, tmp_path):
    path, parts_path = str(tmp_path / "silver"), tmp_path / "parts"
    files.merge_hourly(hours(spark, ((1, 0), 1.0), ((2, 0), 2.0), ((40, 0), 4.0)), path)
    daily.update_parts(spark, path, str(parts_path), None)
    august = sorted(p.name for p in parts_path.glob("month=2025-08/*.parquet"))
    september = sorted(p.name for p in parts_path.glob("month=2025-09/*.parquet"))
    # A day that no one touches: what stands there now must not be seen.
    hours(spark, ((1, 0), 99.0)).write.mode("overwrite").parquet(f"{path}/ts_date=2025-08-01")
    days = files.merge_hourly(hours(spark, ((2, 5), 8.0)), path)
    parts = daily.update_parts(spark, path, str(parts_path), days)
    assert [(r["date"].day, r["avg_temp_c"]) for r in daily.weather_daily(parts).collect()] == [(1, 1.0), (2, 5.0), (9, 4.0)]
    assert august != sorted(p.name for p in parts_path.glob("month=2025-08/*.parquet"))
    assert september == sorted(p.name for p in parts_path.glob("month=2025-09/*.parquet"))


def test_days_are_compacted_when_they_are_full(spark, tmp_path):
    """Many small appends end in few files of the day; another day keeps its names."""
    path = tmp_path / "silver"
    files.merge_hourly(hours(spark, ((9, 0), 1.0), (None, 1.0)), str(path))
    kept = sorted(p.name for p in path.glob("ts_date=2025-08-09/*.parquet"))
    most, compacted = 0, 0
    for h in range(16):
        days = files.merge_hourly(hours(spark, ((1 + h // 12, h % 12), float(h))), str(path))
        compacted += bool(files.compact_full_days(spark, str(path), days, most_files=3))
        most = max(most, *(len(list(path.glob(f"ts_date=2025-08-0{d}/*.parquet"))) for d in (1, 2)))
    assert 2 <= compacted <= 8 and most <= 3 + 1
    assert kept == sorted(p.name for p in path.glob("ts_date=2025-08-09/*.parquet"))
    assert files.read_hourly(spark, str(path)).count() == 18
    assert files.compact_full_days(spark, str(path), [None, date(2025, 8, 9)], most_files=3) == [] == files.compact_full_days(spark, str(path), [])
