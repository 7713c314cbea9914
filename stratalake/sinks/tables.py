"""Warehouse tables and views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.sinks.files import on_days


def replace_contents(df: DataFrame, table: str, location: str | None = None) -> int:
    """Replaces the rows of a table without dropping it, and returns how many were loaded, counted as they are written.

    The first load creates the table, at `location` if given. Later ones are written beside the
    rows that readers see, and the table is switched over when they are complete: it never shows an empty or a half table, a
    failed load changes nothing, views stay valid. Loads take turns in two folders, so that
    readers of the last one can finish.
    """
    spark, counted = df.sparkSession, Observation()
    if not spark.catalog.tableExists(table):
        writer = df.observe(counted, F.count(F.lit(1)).alias("n")).write.format("parquet")
        (writer.option("path", location) if location else writer).saveAsTable(table)
        return counted.get["n"]
    beside = _other_folder(_location(spark, table))
    rows = _as_stored(df, table).observe(counted, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").parquet(beside)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(beside)}")
    spark.catalog.refreshTable(table)
    return counted.get["n"]


def replace_days(df: DataFrame, table: str, day: str, days: Sequence[date | None] | None, location: str | None = None) -> int:
    """Replaces the given days of a table that is stored by day, and returns how many rows were loaded.

    All other days keep their files, and views on the table stay valid. The first load, or
    `days` None, writes every day. `df` holds the column `day` and all rows of these days.
    New days are entered by name, so the folder is not listed.
    """
    spark, counted = df.sparkSession, Observation()
    n = F.count(F.lit(1)).alias("n")
    if not spark.catalog.tableExists(table):
        writer = df.observe(counted, n).write.format("parquet").partitionBy(day)
        (writer.option("path", location) if location else writer).saveAsTable(table)
        return counted.get["n"]
    if days is not None and not days:
        return 0
    rows = _as_stored(df, table)
    if days is not None:
        rows = rows.filter(on_days(F.col(day), days))
    # Days are replaced one by one, also if all are: a reader sees the old or the new rows of each.
    rows.observe(counted, n).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(_location(spark, table))
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} if days is None else set()
    named = {_partition_name(day, d): d for d in (days if days is not None else [r[0] for r in rows.select(day).distinct().collect()])}
    if named:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(_partition(day, d) for d in named.values())}")
    for gone in sorted(known - set(named)):
        value = gone.partition("=")[2]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_partition(day, None if value == NO_VALUE else value)}")
    spark.catalog.refreshTable(table)
    return counted.get["n"]


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _partition_name(day: str, value: date | None) -> str:
    return f"{day}={NO_VALUE if value is None else value.isoformat()}"


def _partition(day: str, value: date | str | None) -> str:
    return f"PARTITION ({day}={'NULL' if value is None else _text(str(value))})"


def _as_stored(df: DataFrame, table: str) -> DataFrame:
    """The rows in the columns and types of the table."""
    stored = df.sparkSession.table(table).schema
    if set(stored.names) != set(df.columns):
        raise ValueError(f"columns of {table} are {stored.names}, not {df.columns}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in stored])


def _location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]


def _other_folder(location: str) -> str:
    """The folder beside a table's that its next load goes to."""
    if location.endswith(".a"):
        return location.removesuffix(".a") + ".b"
    return location.removesuffix(".b") + ".a"


def replace_contents_jdbc(df: DataFrame, url: str, table: str, connections: int = 8, **properties: str) -> None:
    """The same for a database table: truncate, then append in batches of 1000 rows."""
    (
        df.write.format("jdbc").mode("overwrite")
        .options(url=url, dbtable=table, truncate=True, batchsize=1000, numPartitions=connections,
                 **properties)
        .save()
    )


def row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def publish(df: DataFrame, name: str, kind: str = "view", comment: str | None = None,
            location: str | None = None) -> DataFrame:
    """Makes a model available by name, as a view of this session or as a fully rebuilt table."""
    spark = df.sparkSession
    if kind == "view":
        if comment:
            raise ValueError("a view of one session has no place for a comment; see publish_view")
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.format("parquet").mode("overwrite")
        (writer.option("path", location) if location else writer).saveAsTable(name)
        if comment:
            spark.sql(f"COMMENT ON TABLE {name} IS {_text(comment)}")
    else:
        raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
    return spark.table(name)


def publish_view(spark: SparkSession, name: str, columns: Sequence[str], table: str, comment: str | None = None) -> DataFrame:
    """Stores a view of the given columns over a table; other sessions see it too, reloads leave it valid."""
    described = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{described} AS SELECT {', '.join(columns)} FROM {table}")
    return spark.table(name)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
