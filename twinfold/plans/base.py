"""How a module of queries registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..staging import new_folder
from .inputs import frame, oracle

__all__ = ["Registry", "Tables", "new_folder"]


class Tables:
    """The tables of one folder by attribute: base tables and derived inputs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return frame(self.spark, self.sf_dir, name)


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Tables], DataFrame], needs: str = "", sql: str | None = None) -> None:
        self.queries[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql:
            self.oracles[name] = oracle(needs, sql) if needs else sql.strip()
