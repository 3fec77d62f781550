"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OPEN: list[list[str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one below the warehouse folder.

    Both are shared by all executors. A machine-local folder is never chosen: on a
    cluster it would be lost with its executor, so there the warehouse must not be one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = not spark.conf.get("spark.master", "").startswith("local") and (
        warehouse.startswith("file:") or warehouse.startswith("/")
    )
    if local:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{warehouse}/_scratch"


def new_scratch(spark: SparkSession, name: str, outer: bool = False) -> str:
    """A new path; inside ``scratch_tables`` it is deleted at the end.

    ``outer``: it outlives the innermost block and goes with the one around it.
    """
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if len(_OPEN) > outer:
        _OPEN[-1 - outer].append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside once their results have been written.

    with scratch_tables(spark):
        lake.write_silver(product_master(catalogue, listings, "category_id"), "product_master")
    """
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage of a result that is used several times: losing an executor
    later costs a re-read, not a re-computation.
    """
    return _stored(df, new_scratch(df.sparkSession, name))


def kept(df: DataFrame, name: str) -> DataFrame:
    """``stored``, but deleted with the ``scratch_tables`` around the innermost ones, not with those."""
    return _stored(df, new_scratch(df.sparkSession, name, outer=True))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
