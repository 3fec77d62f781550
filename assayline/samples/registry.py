"""Where the example queries are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayline.samples.views import base, view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Source:
    """Tables (``t.orders``) and views (``t.v("listings")``) of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, table: str) -> DataFrame:
        frame = base(self.spark, self.sf_dir, table)
        setattr(self, table, frame)  # the file's schema is read once
        return frame

    def v(self, name: str) -> DataFrame:
        return view(self.spark, name, lambda table: getattr(self, table))


def query(sql: str | None, *views: str) -> Callable:
    """Register a function of a ``Source`` under its own name.

    ``sql`` computes the same rows in another engine from the plain tables and
    the named views.
    """

    def register(fn: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        name = fn.__name__
        QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql
        return fn

    return register
