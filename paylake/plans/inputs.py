"""The lazy pipeline over the stand-in rows that registered queries share."""

from __future__ import annotations

from pyspark.sql import SparkSession

from paylake.plans import models
from paylake.sources import adapter


class Inputs:
    """Lazy pipeline over the stand-in raw rows of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.lake = adapter.lake_rows(spark, sf_dir)
        self.raw = adapter.raw_rows(spark, sf_dir)
        self.stg = models.stg_transactions(self.raw)
        self.enr = models.int_enriched(self.stg)
        self.fact = models.fact_rows(self.enr)
        self.dims = models.dims(spark, self.stg)
