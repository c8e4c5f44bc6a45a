"""Measurements as a stream: the stateless part of the pipeline, and results that are merged per batch.

The library this one follows has no streams; this is an addition, for measurements that arrive all the time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.config import Config
from loomwork.operators import aggregate
from loomwork.sources import tables


def read_values(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """New measurement files of a folder, under the schema of T1 with the time of loading."""
    schema = tables.SCHEMAS["t1"] + ", loaded_at timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def classified(values: DataFrame, t0: DataFrame, t5: DataFrame, config: Config = Config()) -> DataFrame:
    """Arriving measurements with their assay, vector, ``reject`` reason and mapped qualifier; joined to static tables."""
    joined = aggregate.join_measurements(tables.ingest_values(values), t0, t5)
    return aggregate.classify_measurements(joined, config).withColumn("qualifier", aggregate.mapped_qualifier(F.col("standard_qualifier")))


def daily_counts(values: DataFrame, late: str = "7 days") -> DataFrame:
    """Rows and finite values per assay and day of loading; a day is final when nothing later than ``late`` can come."""
    v = F.col("standard_value")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    days = values.withWatermark("loaded_at", late).groupBy(F.window("loaded_at", "1 day").alias("day"), "input_assay_id")
    return days.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(finite).alias("n_values")).select(F.col("day.start").alias("day"), "input_assay_id", "n_rows", "n_values")
