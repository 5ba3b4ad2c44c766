"""Read the logical tables from parquet.

Only the columns of the logical schema are selected (Catalyst prunes further
to what each stage uses), and types are conformed by name so callers can
rely on ``creditflow.schemas``.  A value that doesn't fit its type becomes
NULL; ``contract_report`` says how many do, column by column, before a run
relies on a source.

Tables with a time column can be laid out by day (``write_by_day``).  Given the
run's mark, ``read_tables`` then reads only the days that the run can touch:
orders behind the mark, sessions and installs of the lookback.  (The whole
session history is needed by nothing else once the identity map is maintained,
``creditflow.sources.identity``.)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditflow import schemas
from creditflow.operators.orders import WINDOW_DAYS, ts_lit
from creditflow.sources.versions import Folder

DAY = "_day"
#: Time column of the tables that are read by day, and how many windows before the mark they reach.
BY_DAY = {"orders": ("created_at", 0), "sessions": ("visit_start_time", 2), "appsflyer_data_locker": ("attributed_touch_time", 2)}


def _fitted(df: DataFrame, field: T.StructField) -> Column:
    """The column in its logical type, NULL where a value doesn't fit; NULL altogether when the source lacks it."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    return F.col(f"`{field.name}`").try_cast(field.dataType)


def conform(df: DataFrame, name: str) -> DataFrame:
    schema = schemas.LOGICAL_TABLES[name]
    return df.select(*[_fitted(df, f).alias(f.name) for f in schema.fields])


# ---- contract --------------------------------------------------------------

def _changed(df: DataFrame, field: T.StructField) -> Column:
    """A value that survives the cast as another one: numbers that are cut or rounded."""
    source = df.schema[field.name].dataType
    if not isinstance(source, T.NumericType) or not isinstance(field.dataType, T.NumericType):
        return F.lit(False)
    fitted = _fitted(df, field)
    return fitted.isNotNull() & ~fitted.try_cast(source).eqNullSafe(F.col(f"`{field.name}`"))


def contract_report(df: DataFrame, name: str) -> DataFrame:
    """One row per logical column of ``df`` as a source of ``name`` (one aggregation, not collected).

    ``is_missing``: the source has no such column; ``n_values``: its non-NULL
    values; ``n_lost``: those that become NULL; ``n_changed``: numbers that
    become other numbers.
    """
    fields, aggs = schemas.LOGICAL_TABLES[name].fields, [F.count(F.lit(1)).alias("n_rows")]
    for k, f in enumerate(fields):
        there = f.name in df.columns
        value = F.col(f"`{f.name}`") if there else F.lit(None)
        lost = value.isNotNull() & _fitted(df, f).isNull()
        aggs += [F.count(value).alias(f"v{k}"), F.count_if(lost).alias(f"l{k}"), F.count_if(_changed(df, f) if there else F.lit(False)).alias(f"c{k}")]
    rows = F.array(*[F.struct(
        F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
        F.lit(df.schema[f.name].dataType.simpleString() if f.name in df.columns else None).cast("string").alias("source_type"),
        F.lit(f.dataType.simpleString()).alias("logical_type"), F.lit(f.name not in df.columns).alias("is_missing"), F.col("n_rows"),
        F.col(f"v{k}").alias("n_values"), F.col(f"l{k}").alias("n_lost"), F.col(f"c{k}").alias("n_changed")) for k, f in enumerate(fields)])
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def require_contract(df: DataFrame, name: str) -> None:
    """Stop when a column is missing or loses or changes values; one job, a row per column."""
    bad = contract_report(df, name).where("is_missing or n_lost > 0 or n_changed > 0").collect()
    if bad:
        raise ValueError(f"{name}: " + "; ".join(
            f"{r.column_name} is missing" if r.is_missing else f"{r.column_name} ({r.source_type} as {r.logical_type}) loses {r.n_lost} and changes {r.n_changed} of {r.n_values} values"
            for r in bad))


# ---- reading and layout --------------------------------------------------------

def write_by_day(df: DataFrame, name: str, path: str) -> None:
    """Write a logical table in one folder a day of its time column (``_day``; rows without a time apart)."""
    column, _ = BY_DAY[name]
    day = F.to_date(column)
    df.withColumn(DAY, day).repartition(DAY, F.pmod(F.xxhash64(*df.columns), F.lit(16))).write.partitionBy(DAY).parquet(path)


def _by_day(spark: SparkSession, path: str) -> bool:
    return any(n.startswith(f"{DAY}=") for n in Folder(spark, path).names())


def read_table(spark: SparkSession, name: str, path: str, mark: dt.datetime | None = None, window_days: int = WINDOW_DAYS) -> DataFrame:
    """One logical table; with the run's ``mark``, of a table with a time column only what the run can touch."""
    df = spark.read.parquet(path)
    if mark is not None and name in BY_DAY:
        column, windows = BY_DAY[name]
        since = mark - dt.timedelta(days=windows * window_days)
        df = df.where(F.col(column) > ts_lit(since))
        if DAY in df.columns and _by_day(spark, path):
            df = df.where(F.col(DAY) >= F.lit(since.date()))
    return conform(df, name)


def read_tables(spark: SparkSession, paths: dict[str, str], mark: dt.datetime | None = None, window_days: int = WINDOW_DAYS) -> dict[str, DataFrame]:
    """``paths`` maps logical table names (``schemas.LOGICAL_TABLES``) to parquet paths."""
    return {name: read_table(spark, name, path, mark, window_days) for name, path in paths.items()}


def read_root(spark: SparkSession, root: str, names=None, mark: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Every logical table stored as ``{root}/{name}``."""
    names = names or [n for n in schemas.LOGICAL_TABLES if n != "ledger"]
    return read_tables(spark, {n: f"{root}/{n}" for n in names}, mark)
