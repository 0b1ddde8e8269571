"""The queries this engine registers, each with the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import TABLES, register_tables
from millrace.sql.engine import Engine

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add


def register_sql(name: str, text: str, oracle: str | None = None, checked: bool = True) -> None:
    """A query in the engine's own SQL; the oracle reads the same text unless another is given."""
    used = tuple(t for t in TABLES if re.search(rf"\b{t}\b", text))

    @register(name, (oracle or text) if checked else None)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_tables(spark, sf_dir, used)
        return Engine(spark).sql(text)
