"""Sinks: views for staging, versioned tables for marts, raw tables and test failures.

Schema naming follows the layer settings: a layer with its own schema name
(``staging``, ``core``, ``analytics``) writes there verbatim, otherwise the
session's default database is used.

A full refresh is published in two phases. Every table is first written whole
to a new folder of its own (``<table>/v-...``); only then is the table's pointer
switched to it: the ``_current`` file of a table under a path, replaced by one
rename, or the location of a catalog table. A load or build that fails leaves
every earlier table as it was, and tables written together are switched
together, after the last of them was written. The version before is kept for
readers that opened it; older ones are removed after the switch.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Schema of each layer, and of stored test failures.
LAYER_SCHEMAS = {
    "staging": "staging",
    "intermediate": None,
    "core": "core",
    "analytics": "analytics",
}
FAILURES_SCHEMA = "audit"

POINTER = "_current"


def schema_name(spark: SparkSession, custom: str | None) -> str:
    """Custom schema name verbatim (trimmed), else the session default."""
    if custom is None:
        return spark.catalog.currentDatabase()
    return custom.strip()


def register_view(df: DataFrame, name: str) -> None:
    """View materialization of any DataFrame: a lazily evaluated, session-scoped name.

    Over raw tables in the catalog, ``plans.staging_views`` creates views that outlive it.
    """
    df.createOrReplaceTempView(name)


# ---------------------------------------------------------------- pointers

def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the published version of the table at ``path`` (None: nothing published)."""
    fs, pointer = _file_system(spark, f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return f"{path}/{stream.readUTF()}"
    finally:
        stream.close()


def _point(spark: SparkSession, path: str, version: str) -> None:
    """Replace the pointer by one rename."""
    fs, pointer = _file_system(spark, f"{path}/{POINTER}")
    _, fresh = _file_system(spark, f"{path}/{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    stream.writeUTF(version)
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, fs.makeQualified(pointer), options)


def _remove_older(spark: SparkSession, path: str, keep: set[str | None]) -> None:
    fs, folder = _file_system(spark, path)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in keep:
            fs.delete(status.getPath(), True)


def discard(spark: SparkSession, staged: Sequence[Staged]) -> None:
    """Remove versions that were written but not published."""
    for s in staged:
        if s.bucketed:
            spark.sql(f"DROP TABLE IF EXISTS {s.own_table}")
        fs, folder = _file_system(spark, s.location)
        fs.delete(folder, True)


# ---------------------------------------------------------------- two phases

@dataclass(frozen=True)
class Staged:
    """A version written in full, not yet published."""
    path: str                           # the table's folder
    version: str
    fmt: str
    table: str | None                   # catalog name, if it is a catalog table
    partition_by: tuple[str, ...] = ()
    bucketed: bool = False              # written as a catalog table of the version's own name

    @property
    def own_table(self) -> str:
        return f"{self.table[:-1]}_{self.version.replace('-', '_')}`"

    @property
    def location(self) -> str:
        return f"{self.path}/{self.version}"


def stage_table(spark: SparkSession, df: DataFrame, name: str, schema: str | None,
                path: str | None = None, fmt: str = "parquet",
                partition_by: Sequence[str] = (),
                bucket_by: tuple[int, str] | None = None) -> Staged:
    """First phase: ``df`` in a new version folder of ``path``, or of the catalog table.

    ``bucket_by`` is (buckets, column); rows are sorted by the column in each bucket. Only
    the catalog knows buckets, so such a table has no ``path`` of its own.
    """
    if bucket_by and path:
        raise ValueError("a bucketed table is a catalog table")
    table = None
    if path is None:
        database = schema_name(spark, schema)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        table = f"`{database}`.`{name}`"
        path = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"
    path = path.rstrip("/")
    # the time orders versions for a reader of the folder; the pointer decides
    version = f"v-{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    staged = Staged(path, version, fmt, table, tuple(partition_by), bool(bucket_by))
    if bucket_by:
        (writer.bucketBy(*bucket_by).sortBy(bucket_by[1]).option("path", staged.location)
         .saveAsTable(staged.own_table))
    else:
        writer.save(staged.location)
    return staged


def _publish_catalog(spark: SparkSession, s: Staged) -> str | None:
    """Point the catalog table at the version; returns the version before."""
    written = spark.table(s.own_table) if s.bucketed else spark.read.format(s.fmt).load(s.location)
    before = None
    if spark.catalog.tableExists(s.table.replace("`", "")):
        old = spark.table(s.table)
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {s.table}").collect()
        facts = {r.col_name: r.data_type for r in rows}
        before = facts.get("Location", "").rstrip("/").rsplit("/", 1)[-1]
        partitioned = any(r.col_name == "# Partition Information" for r in rows)
        if (old.schema == written.schema and facts.get("Type") == "EXTERNAL"
                and not (partitioned or s.partition_by or s.bucketed)):
            spark.sql(f"ALTER TABLE {s.table} SET LOCATION '{s.location}'")
            spark.catalog.refreshTable(s.table)
            return before
        spark.sql(f"DROP TABLE {s.table}")                  # its columns or layout changed
    if s.bucketed:
        spark.sql(f"ALTER TABLE {s.own_table} RENAME TO {s.table}")
        return before
    spark.catalog.createTable(s.table.replace("`", ""), path=s.location, source=s.fmt)
    if s.partition_by:
        spark.catalog.recoverPartitions(s.table.replace("`", ""))
    return before


def publish(spark: SparkSession, staged: Sequence[Staged]) -> list[str]:
    """Second phase: switch every table to its new version; the names or folders to read.

    Nothing is written here but one pointer per table.
    """
    out = []
    for s in staged:
        if s.table:
            before = _publish_catalog(spark, s)
        else:
            held = current_version(spark, s.path)
            before = held.rsplit("/", 1)[-1] if held else None
            _point(spark, s.path, s.version)
        _remove_older(spark, s.path, {s.version, before})
        out.append(s.table or s.location)
    return out


def write_table(spark: SparkSession, df: DataFrame, name: str, schema: str | None,
                path: str | None = None, fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> str:
    """Table materialization: full refresh of ``schema.name`` (or of the table at ``path``)."""
    return publish(spark, [stage_table(spark, df, name, schema, path, fmt, partition_by)])[0]


def read_table(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """Open a table that was published: a catalog name, a table's folder, or one version of it."""
    if location.startswith("`"):
        return spark.table(location)
    version = current_version(spark, location.rstrip("/"))
    return spark.read.format(fmt).load(version or location)


# ---------------------------------------------------------------- partitions by month

MONTH = "purchase_month"                # partition column: year * 100 + month (0: no date)


def by_month(df: DataFrame, timestamp: str) -> DataFrame:
    """``df`` with the partition column of its timestamps, rebalanced so that a month is few files."""
    at = F.col(timestamp)
    month = F.coalesce(F.year(at) * 100 + F.month(at), F.lit(0)).cast("int")
    return df.withColumn(MONTH, month).hint("rebalance", MONTH)


def in_window(df: DataFrame, timestamp: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows whose timestamp is within [start, end], days included; of a table partitioned by
    month only the folders of the window are read."""
    if MONTH in df.columns:
        df = df.where(F.col(MONTH).between(start.year * 100 + start.month, end.year * 100 + end.month))
    return df.where(F.to_date(timestamp).between(F.lit(start), F.lit(end)))


def is_missing(exc: AnalysisException) -> bool:
    return exc.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")
