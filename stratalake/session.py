"""Session settings, and the shared folder for written intermediates."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
BYTES_PER_PARTITION = 256 * 1024**2

SETTINGS = {
    # A failed cast must stop the job instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # AQE sizes shuffle partitions and splits skewed join partitions at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "stratalake", master: str | None = None, **conf) -> SparkSession:
    """Session with the library's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_ansi(spark: SparkSession) -> None:
    """Raise if failed casts and overflows would become NULL in this session."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("set spark.sql.ansi.enabled to true")


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (`__` for dots) for what is planned inside the block."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Gives shuffles inside the block enough partitions for an input of that size.

    Adaptive execution merges partitions that turn out small but never adds any, so the
    session's number is only ever raised.
    """
    needed = math.ceil(input_bytes / BYTES_PER_PARTITION)
    with settings(spark, **{SHUFFLE_PARTITIONS: str(max(needed, int(spark.conf.get(SHUFFLE_PARTITIONS))))}):
        yield


def byte_setting(spark: SparkSession, name: str) -> int:
    """A size setting in bytes; sizes may be written with a unit, as in `128m`."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", spark.conf.get(name).lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under a folder that all executors share.

    The cluster names that folder in `spark.checkpoint.dir`; without it, the path lies below
    the warehouse, which every session has and every executor reaches too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
