"""Readers for the input tables."""

from __future__ import annotations

import csv
import io
import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import cut_lineage
from ..functions.timecols import try_double, try_timestamp

def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Parquet table ``{base_dir}/{name}.parquet``; Catalyst prunes columns and
    pushes filters into the scan."""
    return spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))


def read_cohort_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    multi_line: bool = False) -> DataFrame:
    """CSV with header (S1).  ``multi_line`` for files whose quoted fields hold
    line breaks (Spark then reads a file in one task).  Without a schema every
    column is read as string and typed afterwards by :func:`coerce_types`
    (lenient, like the reference)."""
    reader = (spark.read.option("header", True).option("multiLine", multi_line)
              .option("escape", '"').option("mode", "PERMISSIVE"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header whose quoted fields may hold line breaks (S1), read in
    parallel: files of doubled quotes, in which a quote stands only around or
    inside a quoted field.  Same rows as ``read_cohort_csv(multi_line=True)``,
    without its one task per file; row order is not kept.

    Lines are read from byte ranges.  A line starts a record where the number
    of quotes before it in the file is even: each range counts its own under
    both assumptions, and a prefix XOR over the ranges (one row each) says
    which one holds.  Lines of a record are then brought together and parsed."""
    q = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), q.alias("q"))
    lines = cut_lineage(lines, "csv-lines")                       # line numbers of a range hold from here on
    along = Window.partitionBy("file", "block").orderBy("id")
    odd = F.coalesce(F.sum("q").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.select("file", "block", "id", "q", odd.alias("odd")).select(
        "file", "block", "id", "q", *[F.count_if(F.col("odd") == k).over(upto).alias(f"starts{k}") for k in (0, 1)])
    counted = cut_lineage(counted, "csv-starts")
    ranges = counted.groupBy("file", "block").agg((F.sum("q") % 2).alias("odd"), *[F.max(f"starts{k}").alias(f"n{k}") for k in (0, 1)])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    ranges = ranges.withColumn("inside", inside)
    n = F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1"))
    ranges = ranges.withColumn("base", F.coalesce(F.sum(n).over(before), F.lit(0))).select("file", "block", "inside", "base")
    number = F.col("base") + F.when(F.col("inside") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    numbered = lines.join(counted.select("id", "file", "block", "starts0", "starts1"), ["file", "block", "id"]) \
        .join(F.broadcast(ranges), ["file", "block"])             # a row for each byte range
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "id", "value"))), lambda x: x["value"]), "\n")
    text = F.when(F.endswith("text", F.lit("\r")), F.replace(  # a file of CRLF lines: its breaks inside quotes are read as LF
        F.regexp_replace("text", "\\r$", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text"))
    records = numbered.groupBy("file", number.alias("record")).agg(whole.alias("text")).withColumn("text", text)
    if schema is None:
        head = records.where("record = 1").orderBy("file").first()
        if head is None:
            return spark.createDataFrame([], T.StructType([]))
        names = next(csv.reader(io.StringIO(head["text"].lstrip("\ufeff"))))
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = records.where((F.col("record") > 1) & (F.length(F.trim("text")) > 0))
    return rows.select(F.from_csv("text", ddl, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}).alias("r")).select("r.*")


def coerce_types(df: DataFrame, timestamps=(), numerics=(), ids=()) -> DataFrame:
    """Lenient parsing (S3, S5): unparseable timestamps and numbers become
    NULL instead of failing the job (``to_timestamp`` raises under ANSI)."""
    exprs = []
    for f in df.schema.fields:
        c = f.name
        if c in timestamps and not isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            exprs.append(try_timestamp(c).alias(c))
        elif c in ids and not isinstance(f.dataType, T.LongType):
            exprs.append(F.expr(f"try_cast(`{c}` AS BIGINT)").alias(c))
        elif c in numerics and not isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(try_double(F.col(c)).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def with_optional_column(df: DataFrame, name: str, dtype: str = "timestamp_ntz") -> DataFrame:
    """Add an all-NULL column when an optional input column is absent."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def require_columns(df: DataFrame, cols, what: str = "table") -> None:
    """Schema check with the list of missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def numeric_variables(df: DataFrame, exclude=()) -> list[str]:
    """Numeric (or boolean) columns that become model variables.

    Uses the strict rule everywhere: keys, time columns and any ``*_id``
    column are never variables.
    """
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
               T.DoubleType, T.DecimalType, T.BooleanType)
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and not f.name.lower().endswith("_id")
            and isinstance(f.dataType, numeric)]
