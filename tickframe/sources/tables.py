"""Scans (A1-A3). The storage format is a parameter so any Spark connector
(parquet, ORC, a warehouse connector) can stand in for the reference's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def load_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Lazy scan of ``{base}/{name}.{fmt}`` (or a catalog table when ``base``
    is empty). Projection and filters written later reach the scan."""
    if not base:
        return spark.table(name)
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    path = f"{base.rstrip('/')}/{name}.{fmt}" if fmt in ("parquet", "orc", "csv", "json") else f"{base}/{name}"
    return reader.load(path)


def read_csv_typed(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   header: bool = True) -> DataFrame:
    """A2: raw CSV with a declared schema; without one every column is text
    and is repaired by ``operators.cleaning.coerce`` (no inference pass)."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                     line: str = "_line") -> tuple[DataFrame, DataFrame]:
    """A2: raw CSV against a declared schema, as (typed rows, rejected rows).
    A rejected row doesn't fit the schema (a value that can't be read as its
    type, or another number of fields); it keeps its text in ``line``, next
    to the columns that could be read, so that nothing is lost. Both read the
    files with all columns, as a row's fields decide whether it fits."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = (spark.read.schema(StructType([*declared.fields, StructField(line, StringType())]))
            .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
            .option("columnPruning", False).csv(path))
    # whether a row fits must not depend on the columns that a caller selects
    # (Spark parses no others): the text refers to all of them
    anchor = F.substring(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in declared.fields]), 1, 0)
    rows = rows.withColumn(line, F.concat(F.col(line), anchor))
    return rows.where(F.col(line).isNull()).drop(line), rows.where(F.col(line).isNotNull())


def write_by_year(df: DataFrame, path: str, date: str = "Date", year: str = "Year") -> DataFrame:
    """A1: a raw table as Parquet, one folder per calendar year of ``date``
    (unreadable dates in one of their own), and the scan over it: filters on
    the year select folders, also those that a join finds at run time, and
    filters on other columns reach the files."""
    if year not in df.columns:
        df = df.withColumn(year, F.year(F.col(date).try_cast("date")))
    df.write.partitionBy(year).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A3: expose a DataFrame to SQL users."""
    df.createOrReplaceTempView(name)
    return df


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)
