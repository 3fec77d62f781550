"""Reading and writing tables of the Bronze, Silver and Gold layers.

A layer is a directory of parquet tables under one root. Rows go from the scan
to the writers on the executors; the driver sees a count and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayline.sources.literals import literal_table


def lower_names(df: DataFrame) -> DataFrame:
    """Column names in lower case; a no-op if they already are."""
    return df.withColumnsRenamed({c: c.lower() for c in df.columns if c != c.lower()})


def read_path(
    spark: SparkSession, path: str, select: str = "*", where: str | None = None
) -> DataFrame:
    """Scan a parquet table with a projection list and predicate in SQL text.

    Both see the source columns; Catalyst pushes them into the scan.
    """
    # braces in the caller's text are not places to fill in
    select, where = (text.replace("{", "{{").replace("}", "}}") for text in (select, where or "TRUE"))
    query = f"SELECT {select} FROM {{source}} WHERE {where}"
    return lower_names(spark.sql(query, source=spark.read.parquet(path)))


def write_path(
    df: DataFrame,
    path: str,
    overwrite: bool = True,
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 0,
) -> int:
    """Write parquet in parallel and return the number of rows written.

    Rows are counted while they are written, in the same job. Overwriting makes
    a rerun leave the same table behind; an empty frame leaves a typed one. With
    ``partition_by`` rows are first brought together by those columns, so that a
    small partition is one file; adaptive execution splits the large ones.
    """
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.mode("overwrite" if overwrite else "append").parquet(path)
    return seen.get["rows"]


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """A table with its declared types and no rows."""
    return literal_table(spark, [], schema)


@dataclass(frozen=True)
class Medallion:
    """The three layers under one root folder."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer.lower()}/{table.lower()}"

    def read_table(
        self, table: str, layer: str, select: str = "*", where: str | None = None
    ) -> DataFrame:
        return read_path(self.spark, self.path(layer, table), select, where)

    def read_bronze(self, table: str, select: str = "*", where: str | None = None) -> DataFrame:
        return self.read_table(table, "bronze", select, where)

    def read_silver(self, table: str, select: str = "*", where: str | None = None) -> DataFrame:
        return self.read_table(table, "silver", select, where)

    def write_table(self, df: DataFrame, table: str, layer: str, overwrite: bool = True, **options) -> int:
        return write_path(df, self.path(layer, table), overwrite, **options)

    def write_silver(self, df: DataFrame, table: str, overwrite: bool = True, **options) -> int:
        return self.write_table(df, table, "silver", overwrite, **options)

    def write_gold(self, df: DataFrame, table: str, overwrite: bool = True, **options) -> int:
        return self.write_table(df, table, "gold", overwrite, **options)

    def write_and_verify(self, df: DataFrame, table: str, layer: str = "silver") -> int:
        """Write, read back, and compare row count, names and types."""
        written = self.write_table(df, table, layer)
        back = self.read_table(table, layer)
        want = [(f.name.lower(), f.dataType) for f in df.schema.fields]
        have = [(f.name, f.dataType) for f in back.schema.fields]
        if want != have:
            raise ValueError(f"{layer}.{table} came back as {have}, written as {want}")
        found = back.count()
        if found != written:
            raise ValueError(f"{layer}.{table}: {written} rows written, {found} read back")
        return written
