"""Registered queries over the driver tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("q_core", "q_more", "q_marts", "q_docs", "q_records")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"tarn.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return SQL
