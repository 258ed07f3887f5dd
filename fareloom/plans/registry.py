"""Named questions over the driver tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareloom.plans.views import Views

QUESTIONS: dict[str, Callable[[Views], DataFrame]] = {}
SQL: dict[str, str] = {}


def question(name: str, sql: str | None = None):
    def keep(fn: Callable[[Views], DataFrame]):
        if name in QUESTIONS:
            raise ValueError(f"question {name!r} is registered twice")
        QUESTIONS[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: QUESTIONS[name](Views(spark, sf_dir))
