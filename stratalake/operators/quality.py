"""Data tests: not-null, unique and relationship, reported as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedup import stack_by_name


@dataclass(frozen=True)
class Reference:
    """`column` of the tested model must occur as `parent_column` of model `parent`."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class ModelTests:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()


# The tests declared for each model.
DECLARED_TESTS: dict[str, ModelTests] = {
    "stg_orders": ModelTests(not_null=("order_id", "product", "quantity", "total")),
    "fct_sales_by_product": ModelTests(not_null=("product", "revenue"), unique=("product",)),
    "stg_weather": ModelTests(),
    "dim_date": ModelTests(not_null=("date_key", "date"), unique=("date_key",)),
    "dim_weather": ModelTests(not_null=("date_key", "date"), unique=("date_key",)),
    "dim_product": ModelTests(not_null=("product_key", "product"), unique=("product_key",)),
    "fact_sales": ModelTests(
        not_null=("order_id", "product_key", "revenue_eur"),
        references=(Reference("product_key", "dim_product", "product_key"),),
    ),
}


def not_null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, test, failures) for all columns from one pass over the model."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit("not_null").alias("test"), F.col(c).alias("failures"))
        for c in columns
    ])
    return counts.select(F.inline(pairs))


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their row count; NULLs are left out."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    )


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    return _counted(duplicated_values(df, column), column, "unique", F.count("*"))


def orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row, with the number of child rows that carry them.

    Both sides are reduced to distinct values before they meet, so a value that fills a third
    of the rows moves once per task. The join reuses the partitioning of these aggregates.
    """
    values = (
        child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
    )
    parents = parent.select(F.col(parent_column).alias("parent_value")).distinct()
    return values.join(parents, F.col("value") == F.col("parent_value"), "left_anti")


def reference_failures(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    orphans = orphan_values(child, column, parent, parent_column)
    return _counted(orphans, column, "relationships", F.coalesce(F.sum("n_rows"), F.lit(0)))


def run_tests(
    models: Mapping[str, DataFrame], declared: Mapping[str, ModelTests] = DECLARED_TESTS
) -> DataFrame:
    """(model, column, test, failures), one row per declared test of the given models.

    All tests of a model share one pass over it, plus one over the parent of each reference.
    """
    reports = []
    for name, tests in declared.items():
        if name in models and (tests.not_null or tests.unique or tests.references):
            reports.append(_one_pass(models[name], tests, models).select(F.lit(name).alias("model"), "*"))
    if not reports:
        raise ValueError("none of the given models has a declared test")
    return stack_by_name(reports)


def _one_pass(df: DataFrame, tests: ModelTests, models: Mapping[str, DataFrame]) -> DataFrame:
    """NULL counts, uniqueness and references of a model.

    One aggregate groups the rows by each column that is a key or refers to a parent, as grouping sets if there are several.
    """
    keys = list(dict.fromkeys([*tests.unique, *(r.column for r in tests.references)]))
    if not keys:
        return not_null_failures(df, tests.not_null)
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    nulls = {c: f"_null_{i}" for i, c in enumerate(tests.not_null)}
    given = df.select(*[F.col(k).alias(n) for k, n in names.items()], *[F.col(c).isNull().alias(n) for c, n in nulls.items()])
    sums = [F.count("*").alias("_rows"), *[F.count_if(n).alias(n) for n in nulls.values()]]
    if len(keys) == 1:
        groups, own = given.groupBy(*names.values()).agg(*sums), {keys[0]: F.lit(True)}
    else:
        places = [F.grouping(n).alias(f"_not{n}") for n in names.values()]
        groups = given.groupingSets([[F.col(n)] for n in names.values()], *names.values()).agg(*sums, *places)
        own = {k: F.col(f"_not{n}") == 0 for k, n in names.items()}
    # Every row is in one group of each set, so NULLs are added up over one of them.
    failures = [(c, "not_null", F.sum(F.when(own[keys[0]], F.col(n)))) for c, n in nulls.items()]
    for key in tests.unique:
        failures.append((key, "unique", F.count_if(own[key] & F.col(names[key]).isNotNull() & (F.col("_rows") > 1))))
    for i, reference in enumerate(tests.references):
        key, found = names[reference.column], f"_found_{i}"
        parents = models[reference.parent].select(F.col(reference.parent_column).alias("_parent")).distinct()
        groups = groups.join(parents.withColumn(found, F.lit(True)), F.col(key) == F.col("_parent"), "left").drop("_parent")
        orphaned = own[reference.column] & F.col(key).isNotNull() & F.col(found).isNull()
        failures.append((reference.column, "relationships", F.sum(F.when(orphaned, F.col("_rows")))))
    counts = groups.agg(*[F.coalesce(n.cast("bigint"), F.lit(0).cast("bigint")).alias(f"_{i}") for i, (_, _, n) in enumerate(failures)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(test).alias("test"), F.col(f"_{i}").alias("failures"))
        for i, (c, test, _) in enumerate(failures)
    ])
    return counts.select(F.inline(rows))


def require_passed(report: DataFrame) -> None:
    """Raise if a test failed. The report has one row per test, so it fits the driver."""
    failed = report.filter("failures > 0").collect()
    if failed:
        lines = [f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in failed]
        raise AssertionError("data tests failed: " + "; ".join(lines))


def _counted(failing: DataFrame, column: str, test: str, failures: Column) -> DataFrame:
    return failing.agg(failures.alias("failures")).select(
        F.lit(column).alias("column"), F.lit(test).alias("test"), "failures"
    )
