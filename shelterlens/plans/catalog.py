"""Registered queries over the benchmark tables and their DuckDB oracle SQL.

Every query reads whole benchmark tables through the role mapping and runs the
library's report operators over every month that holds data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelterlens.plans import incidence as inc
from shelterlens.plans.oracle_incidence import incidence_sql
from shelterlens.plans.params import AS_OF, SPINE
from shelterlens.plans.roles import model_from_driver

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


_loaded = False


def _load_all() -> None:
    global _loaded
    if _loaded:
        return
    _loaded = True
    # importing the modules registers their queries
    from shelterlens.plans import basics, catalog_more  # noqa: F401


# ---------------------------------------------------------------- incidence
DIARRHEA = inc.DISEASES["diarrhea"]


@register("numerator_onset", incidence_sql(DIARRHEA, "numerator"))
def numerator_onset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.incidence_numerator(model_from_driver(spark, sf_dir), SPINE, DIARRHEA)


@register("stock_at_month_start", incidence_sql(DIARRHEA, "stock"))
def stock_at_month_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.stock_population(model_from_driver(spark, sf_dir), SPINE, DIARRHEA)


@register("flow_without_early_onset", incidence_sql(DIARRHEA, "flow"))
def flow_without_early_onset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.flow_population(model_from_driver(spark, sf_dir), SPINE, DIARRHEA)


@register("at_risk_population", incidence_sql(DIARRHEA, "population"))
def at_risk_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.population_at_risk(model_from_driver(spark, sf_dir), SPINE, DIARRHEA)


@register("incidence_chart_rows", incidence_sql(DIARRHEA, "chart"))
def incidence_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.incidence_report(model_from_driver(spark, sf_dir), SPINE, DIARRHEA, AS_OF)["chart"]


@register("infection_percent", incidence_sql(DIARRHEA, "percent"))
def infection_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.infection_percent_report(model_from_driver(spark, sf_dir), SPINE, DIARRHEA, AS_OF)


# the other three disease configurations (one implementation, four parameter sets)
@register("uri_infection_percent", incidence_sql(inc.DISEASES["uri"], "percent"))
def uri_infection_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.infection_percent_report(model_from_driver(spark, sf_dir), SPINE, inc.DISEASES["uri"], AS_OF)


@register("parvo_chart_rows", incidence_sql(inc.DISEASES["parvo"], "chart"))
def parvo_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.incidence_report(model_from_driver(spark, sf_dir), SPINE, inc.DISEASES["parvo"], AS_OF)["chart"]


@register("ringworm_chart_rows", incidence_sql(inc.DISEASES["ringworm"], "chart"))
def ringworm_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.incidence_report(model_from_driver(spark, sf_dir), SPINE, inc.DISEASES["ringworm"], AS_OF)["chart"]
