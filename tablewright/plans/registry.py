"""Query registry: a Spark callable per operator id and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablewright.plans.views import Tables, oracle_text

Plan = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, views: str = "", sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan; `views` lists the views its oracle needs."""

    def register(plan: Plan) -> Plan:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(plan, oracle_text(views, sql) if sql else None)
        return plan

    return register


def load_all() -> dict[str, Query]:
    """Import every section so that its queries are registered."""
    from tablewright.plans import load_sections

    load_sections()
    return REGISTRY
