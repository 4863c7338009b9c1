"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables through the stand-in adapter and runs
the library's own pipeline on them; nothing here computes a result itself.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from paylake.plans import models, panels, quality
from paylake.plans.inputs import Inputs
from paylake.session import scratch_path


def _panel(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return panels.run_panel(name, i.fact, i.dims)


def _model(attr: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    if attr == "dim_location":
        return i.dims.location
    return getattr(i, attr)


def _local_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.hourly_volume_local(Inputs(spark, sf_dir).fact)


QUERIES = {name: partial(_panel, name) for name in panels.PANEL_NAMES}
QUERIES.update({
    "model_stg_transactions": partial(_model, "stg"),
    "model_int_enriched": partial(_model, "enr"),
    "model_fact": partial(_model, "fact"),
    "model_dim_location": partial(_model, "dim_location"),
    "fn_local_time": _local_hours,
})


def _stored(i: Inputs):
    """Staging and fact built once and stored, and the dimensions, as the refresh has them."""
    root = scratch_path(i.spark, "dq")
    i.stg.write.parquet(f"{root}/stg")
    stg = i.spark.read.schema(i.stg.schema).parquet(f"{root}/stg")
    fact = models.fact_rows(models.int_enriched(stg))
    fact.write.parquet(f"{root}/fact")
    fact = i.spark.read.schema(fact.schema).parquet(f"{root}/fact")
    dims = models.Dims(i.dims.date, models.dim_location_from_fact(fact), i.dims.merchant, i.dims.upi_app,
                       i.dims.payment_type)
    return stg, fact, dims


def _unfiltered_fact(i: Inputs):
    """The fact of all latest versions, those with a non-positive amount included."""
    return models.fact_rows(models.int_enriched(models.staged_columns(models.latest_versions(i.raw))))


_TABLE_TESTS = {"dq_report": quality.dq_report, "dq_unique": quality.dq_unique, "dq_not_null": quality.dq_not_null,
                "dq_accepted_values": quality.dq_accepted_values}
_OTHER_TESTS = {
    "dq_relationships": lambda i: quality.dq_relationships(i.fact, i.dims),
    "dq_no_negative_amounts": lambda i: quality.dq_no_negative_amounts(i.fact),
    "dq_negative_amounts_found": lambda i: quality.dq_no_negative_amounts(_unfiltered_fact(i)).select(
        "txn_id", "amount_inr", "status"),
    "dq_success_rate_floor": lambda i: quality.dq_success_rate_floor(i.fact),
    "dq_success_rate_too_low": lambda i: quality.dq_success_rate_floor(i.fact.filter("status <> 'SUCCESS'")),
    "dq_festival_disagreement": lambda i: quality.dq_festival_disagreement(i.fact, i.dims),
    "dq_row_rules": lambda i: quality.dq_row_rules(i.lake),
    "dq_quarantine": lambda i: quality.dq_quarantine(i.lake),
    "dq_amount_in_category_range": lambda i: quality.dq_amount_in_category_range(i.lake),
    "dq_calendar_flags": lambda i: quality.dq_calendar_flags(i.lake),
}


def _table_test(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _TABLE_TESTS[name](*_stored(Inputs(spark, sf_dir)))


def _other_test(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _OTHER_TESTS[name](Inputs(spark, sf_dir))


QUERIES.update({k: partial(_table_test, k) for k in _TABLE_TESTS})
QUERIES.update({k: partial(_other_test, k) for k in _OTHER_TESTS})


def _scenarios():
    from paylake.plans.scenarios import SCENARIOS
    return SCENARIOS


QUERIES.update(_scenarios())


def _inventory():
    from paylake.plans import inventory

    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))
        run.__doc__ = fn.__doc__
        return run
    out = {k: bind(f) for k, f in inventory.INVENTORY.items()}
    return out, inventory.SAME_AS


_inv, _same = _inventory()
QUERIES.update(_inv)
for _k, _v in _same.items():
    QUERIES[_k] = QUERIES[_v]
