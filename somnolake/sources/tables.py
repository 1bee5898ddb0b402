"""Typed writes: conforming to a declared schema, full refresh, table registration."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructType, VarcharType

from somnolake.operators.quality import Gate, key_report

STAMP = "dwh_create_date"

# A load is written by at most as many tasks, a file each, at any size.
MAX_FILES = 100_000


def _conformed(name: str, kind: DataType, bounded: bool) -> str:
    if not isinstance(kind, VarcharType):
        return f"CAST({name} AS {kind.simpleString()}) AS {name}"
    text = f"CAST({name} AS string)"
    if bounded:
        return f"{text} AS {name}"
    problem = f"raise_error(concat('{name}: text longer than {kind.length}: ', {text}))"
    return f"CASE WHEN length({text}) > {kind.length} THEN {problem} ELSE {text} END AS {name}"


def conform(
    rows: DataFrame, schema: StructType, keep: Sequence[str] = (), bounded: Sequence[str] = ()
) -> DataFrame:
    """Select the declared columns in order and cast each to its declared type.

    A number that does not fit its type and text longer than its column are errors.
    ``keep`` names further columns to carry in front, where ``rows`` has them;
    ``bounded`` names text columns that cannot be too long, which are not measured.
    """
    carried = [name for name in keep if name in rows.columns]
    return rows.selectExpr(
        *carried, *(_conformed(f.name, f.dataType, f.name in bounded) for f in schema)
    )


def stamped(rows: DataFrame, moment: datetime.datetime) -> DataFrame:
    """Add the load time: one value for every table of a run."""
    return rows.withColumn(STAMP, F.lit(moment.isoformat(" ")).cast("timestamp_ntz"))


def write_refresh(rows: DataFrame, folder: str) -> str:
    """Write a full refresh beside the versions already in ``folder`` and return its path.

    Nothing is overwritten, so the source of ``rows`` may be an earlier version, and a
    failed write leaves that version in place.
    """
    path = f"{folder}/v-{uuid.uuid4().hex}"
    rows.coalesce(MAX_FILES).write.mode("errorifexists").parquet(path)
    return path


def point_table(spark: SparkSession, table: str, rows: DataFrame, path: str) -> DataFrame:
    """Make ``table`` name the Parquet files at ``path``."""
    current = spark.table(table).schema if spark.catalog.tableExists(table) else None
    if current is not None and current.simpleString() == rows.schema.simpleString():
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=path, source="parquet", schema=rows.schema)
    return spark.table(table)


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the versions below ``folder``, the latest written first."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    found = [
        (status.getModificationTime(), status.getPath().getName())
        for status in files.listStatus(where)
        if status.isDirectory() and status.getPath().getName().startswith("v-")
    ]
    return [name for _, name in sorted(found, reverse=True)]


def expire_versions(spark: SparkSession, folder: str, current: str, keep: int) -> list[str]:
    """Delete all versions below ``folder`` but ``current`` and the latest others, ``keep`` in all.

    Returns the names of those deleted.  A query that still reads a deleted version fails, so
    ``keep`` should cover the loads that the longest query may see.
    """
    if keep < 1:
        raise ValueError(f"at least the current version is kept, not {keep}")
    held = current.rstrip("/").rsplit("/", 1)[-1]
    known = versions(spark, folder)
    if held not in known:
        raise ValueError(f"{current} is no version of {folder}")
    gone = [name for name in known if name != held][keep - 1:]
    for name in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def full_refresh(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    folder: str,
    key: str | None = None,
    gate: Gate = Gate(),
    keep: int | None = None,
) -> DataFrame:
    """Replace the content of ``table`` by ``rows``.

    Rules of ``gate`` are counted as the rows are written.  With a ``key``, the written files
    are checked too.  Where a rule is broken or a key repeats or is missing, the table stays as it
    was.  With ``keep``, older versions than that many are deleted once the table is pointed.
    """
    watched, seen = gate.watch(rows)
    path = write_refresh(watched, folder)
    gate.check(table, seen)
    if key is not None:
        report = key_report(spark.read.parquet(path), key).first()
        if report["duplicate_keys"] or report["null_keys"]:
            raise ValueError(f"primary key {key} of {table}: {report.asDict()}")
    pointed = point_table(spark, table, rows, path)
    if keep is not None:
        expire_versions(spark, folder, path, keep)
    return pointed
