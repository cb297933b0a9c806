"""CSV scan of the raw marketplace files and the full-refresh load.

Files are read by executors in splits. The free text of reviews may hold line
breaks, so their records are cut by quote parity (:mod:`agora.sources.records`),
which works on any split. No row passes through the driver. The
header decides the column order; every column is then cast by name to the
explicit type in :data:`RAW_SCHEMAS` (no inference). Empty fields become NULL,
zip prefixes such as ``01046`` become the integer 1046, quoted fields may hold
commas, doubled quotes and (in reviews) line breaks, and a UTF-8 byte-order mark is dropped.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.functions.compat import to_int
from agora.operators.skew import hot_keys
from agora.sources.records import records
from agora.sources.schemas import RAW_FILES, RAW_SCHEMAS
from agora.sources.sinks import (
    MONTH, by_month, discard, is_missing, publish, read_table, stage_table)

log = logging.getLogger(__name__)


# Rows of a table below which no order is set apart.
HOT_LEAST = 100_000

# Tables partitioned by month, and the timestamp that decides it.
BY_MONTH = {"orders": "order_purchase_timestamp"}

# Tables whose quoted fields may hold line breaks.
MULTI_LINE = ("order_reviews",)


def _typed(df: DataFrame, table: str) -> DataFrame:
    schema = RAW_SCHEMAS[table]
    cols = []
    for field in schema.fields:
        c = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "integer":
            # text like "3.0" must round like a numeric cast, not fail
            cols.append(to_int(c.cast("double"), T.DoubleType()).alias(field.name))
        else:
            cols.append(c.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def read_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read one raw CSV file (or folder of parts, each with a header) as its typed raw table.

    The parts of a folder have their columns in one order.
    """
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    raw = spark.read.options(**options).option("header", True).csv(path)
    if table in MULTI_LINE:
        header = T.StructType([T.StructField(c, T.StringType()) for c in raw.columns])
        parsed = F.from_csv("record", F.lit(_ddl(header)), options)
        raw = records(spark, path).select(parsed.alias("r")).select("r.*")
    return _typed(raw, table)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_raw_folder(spark: SparkSession, folder: str,
                    files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Read every raw table found in ``folder``.

    A missing file is skipped with a warning; any other fault (a missing
    column, say) is an error.
    """
    tables: dict[str, DataFrame] = {}
    for table, name in (files or RAW_FILES).items():
        path = f"{folder.rstrip('/')}/{name}"
        try:
            df = read_raw_csv(spark, path, table)
        except AnalysisException as exc:
            if not is_missing(exc):
                raise
            log.warning("no file for raw table %s: %s", table, path)
            continue
        tables[table] = df
    return tables


@dataclass
class LoadResult:
    table: str
    rows: int
    location: str


def load_raw(spark: SparkSession, folder: str, target: str | None,
             files: dict[str, str] | None = None, fmt: str = "parquet",
             database: str = "raw") -> list[LoadResult]:
    """Full refresh: each CSV found replaces its table under ``target`` (None: in the
    catalog, as ``<database>.<table>``).

    Re-running gives the same tables. All files are written to new versions
    first and published together, so a load that fails leaves every earlier
    table as it was. Orders are partitioned by the month of their purchase, so
    that a date window reads its months only. The row count of each table is
    observed on the write itself, so the data is read once.
    """
    staged, rows = {}, {}
    try:
        for table, df in read_raw_folder(spark, folder, files).items():
            obs = Observation(f"load_{table}")
            df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
            months = table in BY_MONTH
            staged[table] = stage_table(
                spark, by_month(df, BY_MONTH[table]) if months else df, table, database,
                f"{target.rstrip('/')}/{table}" if target else None, fmt, [MONTH] if months else [])
            rows[table] = int(obs.get["rows"])
    except BaseException:
        discard(spark, list(staged.values()))
        raise
    results = [LoadResult(table, rows[table], location)
               for table, location in zip(staged, publish(spark, list(staged.values())))]
    for r in results:
        log.info("raw table %s: %d rows at %s", r.table, r.rows, r.location)
    return results


def read_loaded(spark: SparkSession, target: str | None, fmt: str = "parquet",
                database: str = "raw") -> dict[str, DataFrame]:
    """Open the tables written by :func:`load_raw`; a table that was not loaded is left out
    with a warning."""
    out = {}
    for table in RAW_SCHEMAS:
        try:
            out[table] = read_table(spark, f"{target.rstrip('/')}/{table}" if target
                                    else f"`{database}`.`{table}`", fmt)
        except AnalysisException as exc:
            if not is_missing(exc):
                raise
            log.warning("raw table %s was not loaded under %s", table, target or database)
    return out


# ------------------------------------------------------------ co-partitioned storage

# Fact tables that meet on order_id.
BY_ORDER = ("orders", "order_items", "order_payments", "order_reviews")
HOT = "_hot"
# Most rows of a table that a bucket is meant to hold: one task rolls up and joins a bucket.
BUCKET_ROWS = 250_000


def load_bucketed(spark: SparkSession, raw: Mapping[str, DataFrame], buckets: int,
                  database: str = "raw") -> dict[str, DataFrame]:
    """The fact tables bucketed and sorted by order_id, as catalog tables published together.

    Joins and roll-ups on order_id over them need no exchange. There are at least
    ``buckets`` of them, and more where the largest table has over ``BUCKET_ROWS`` rows for
    each: what a task holds does not grow with the tables. A bucket holds
    whole orders, so the rows of an order with at least 1/1000 of a table (of
    which there are at most 1000) go to a side table ``<table>_hot`` that is dealt
    evenly; it is written only where such orders exist. Returns :func:`read_bucketed`.
    """
    staged = []
    rows = {table: raw[table].count() for table in BY_ORDER}
    buckets = max(buckets, -(-max(rows.values()) // BUCKET_ROWS))
    try:
        for table in BY_ORDER:
            df, rest = raw[table], raw[table]
            if table != "orders":                           # unique there
                keys = ([r.order_id for r in hot_keys(df, "order_id").collect()]
                        if rows[table] >= HOT_LEAST else [])
                is_hot = F.col("order_id").isin(keys) if keys else F.lit(False)
                rest = df.where(~F.coalesce(is_hot, F.lit(False)))
                if keys:
                    staged.append(stage_table(spark, df.where(is_hot), table + HOT, database))
                else:
                    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
                    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}{HOT}`")
            staged.append(stage_table(spark, rest.repartition(buckets, "order_id"), table, database,
                                      bucket_by=(buckets, "order_id")))
    except BaseException:
        discard(spark, staged)
        raise
    publish(spark, staged)
    return read_bucketed(spark, raw, database)


def read_bucketed(spark: SparkSession, raw: Mapping[str, DataFrame],
                  database: str = "raw") -> dict[str, DataFrame]:
    """``raw`` with its fact tables read from the bucketed ones.

    A table with hot orders is there three times: whole, and its parts as
    ``<table>_cold`` (bucketed) and ``<table>_hot``.
    """
    out = dict(raw)
    for table in BY_ORDER:
        cold = spark.table(f"`{database}`.`{table}`")
        out[table] = cold
        if spark.catalog.tableExists(f"{database}.{table}{HOT}"):
            hot = spark.table(f"`{database}`.`{table}{HOT}`")
            out[table], out[f"{table}_cold"], out[f"{table}{HOT}"] = cold.unionByName(hot), cold, hot
    return out
