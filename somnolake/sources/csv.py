"""The three ways raw extracts are read.

All take the columns by position from a declared schema, skip one header line per file
and infer nothing.  Text such as ``None``, ``NA``, ``Yes`` or ``No`` stays text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType, VarcharType

_COMMON = {
    "header": "true",
    # the header names differ from the column names; position decides
    "enforceSchema": "true",
    "mode": "FAILFAST",
}

STYLES = {
    # no quoting: a quote is an ordinary character
    "plain": {"quote": ""},
    # quoted fields may hold commas; a quote inside is doubled
    "quoted": {"quote": '"', "escape": '"'},
    # as quoted; an empty field is NULL
    "keepnulls": {"quote": '"', "escape": '"', "nullValue": ""},
}

# How each extract is written.
SOURCE_STYLES = {
    "diabetes_data": "plain",
    "diabetes_dataset_10k": "plain",
    "diabetes_prediction": "plain",
    "enhanced_sleep_sdb": "quoted",
    "sleep_apnea_dataset": "quoted",
    "diabetes_all_2016": "quoted",
    "diabetes_hypertension_2016": "quoted",
    "hypertension_risk": "keepnulls",
    "sleep_data_sampled": "keepnulls",
    "sleep_health_lifestyle": "keepnulls",
}

# Extracts with notes that may hold line breaks inside quotes.
FREE_TEXT_SOURCES = frozenset({"enhanced_sleep_sdb"})


def _readable(schema: StructType) -> StructType:
    return StructType(
        [
            StructField(f.name, StringType() if isinstance(f.dataType, VarcharType) else f.dataType)
            for f in schema
        ]
    )


def read_csv(
    spark: SparkSession, path: str, schema: StructType, style: str, multi_line: bool = False
) -> DataFrame:
    """Read a file or folder of CSV files.

    ``multi_line`` is for free text with line breaks inside quotes; files are split all the
    same, see ``_records``.
    """
    if multi_line and STYLES[style]["quote"]:
        options = {"mode": "FAILFAST", **STYLES[style]}
        row = F.from_csv("_record", _readable(schema).toDDL(), options)
        return _records(spark, path).select(row.alias("_row")).select("_row.*")
    reader = spark.read.schema(_readable(schema)).options(**_COMMON, **STYLES[style])
    return reader.csv(path)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """One ``_record`` for each record of the files but the first, line breaks in quotes included.

    Spark's reader takes a file with such breaks whole, in one task.  Here the lines of each
    split are read by themselves and the quotes counted: a line begins a record where the
    number of quotes before it is even.  That number is a sum over the splits before, one row
    each, and a running sum within the split.  Only lines of records that go over several are
    put together; such a record may begin in one split and end in a later one.

    Quotes enclose whole fields and are doubled inside; a line ends in LF or CRLF, and breaks
    inside quotes stay as they are.
    """
    quote = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        quote.cast("bigint").alias("_quotes"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        # rising within a split
        F.monotonically_increasing_id().alias("_at"),
    )
    split = ["_file", "_split"]
    of_file = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    of_split = Window.partitionBy(*split).orderBy("_at")
    parity = (
        lines.groupBy(*split).agg(F.sum("_quotes").alias("_sum"))
        .select(*split, F.coalesce(F.sum("_sum").over(of_file), F.lit(0)).alias("_before"))
    )
    before = of_split.rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.col("_before") + F.coalesce(F.sum("_quotes").over(before), F.lit(0))
    # a row a split, so one for every spark.sql.files.maxPartitionBytes of the files
    placed = lines.join(F.broadcast(parity), split).withColumn("_begins", so_far % 2 == 0)
    numbered = placed.withColumn("_number", F.count_if("_begins").over(
        of_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ))
    whole = F.col("_begins") & (F.col("_quotes") % 2 == 0)
    alone = numbered.where(whole).select(*split, "_number", F.col("value").alias("_record"))
    # lines in front of a split's first record go on with the last record before it
    last = F.when(F.col("_records") > 0, F.struct("_split", F.col("_records").alias("_number")))
    latest = numbered.groupBy(*split).agg(F.count_if("_begins").alias("_records")).select(
        *split, F.last(last, ignorenulls=True).over(of_file).alias("_open")
    )
    ours = F.struct("_split", "_number")
    parts = numbered.where(~whole).join(F.broadcast(latest), split).select(
        "_file", F.when(F.col("_number") > 0, ours).otherwise(F.col("_open")).alias("_of"),
        F.struct("_split", "_at", "value").alias("_line"),
    )
    in_order = F.transform(F.array_sort(F.collect_list("_line")), lambda line: line["value"])
    joined = parts.groupBy("_file", "_of").agg(F.array_join(in_order, "\n").alias("_record")).select(
        "_file", "_of._split", "_of._number", "_record"
    )
    records = alone.unionByName(joined).where(~_first_of_file())
    return records.select(F.regexp_replace("_record", "\r$", "").alias("_record")).where("_record <> ''")


def _first_of_file() -> Column:
    return (F.col("_split") == 0) & (F.col("_number") == 1)
