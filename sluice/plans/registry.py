"""Registered queries: a Spark plan over the given tables and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.session import plain_unions, scratch_path
from sluice.sources.files import read_files

Plan = Callable[["Tables"], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._frames = spark, folder, {}
        plain_unions(spark)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = read_files(self.spark, self.path(name))
        return self._frames[name]

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


def plan(key: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def keep(fn: Plan) -> Plan:
        if key in PLANS:
            raise ValueError(f"{key} is registered twice")
        PLANS[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return keep
