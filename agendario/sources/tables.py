"""Readers of the driver's Parquet tables, and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

_INFERRED = "spark.sql.variant.inferShreddingSchema"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _variants_whole(spark: SparkSession) -> Iterator[None]:
    """VARIANT values are written as they are: columns inferred for their members cost far more than one later reading saves."""
    was = spark.conf.get(_INFERRED, None)
    spark.conf.set(_INFERRED, "false")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_INFERRED)
        else:
            spark.conf.set(_INFERRED, was)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below ``spark.checkpoint.dir`` and reads it again, so that lost executors cost no earlier work.

    The folder must be shared by driver and executors; only local mode may go without the setting.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="agendario-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    with _variants_whole(spark) if any("variant" in kind for _, kind in df.dtypes) else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
