"""Tables and scratch space that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is not set, a local folder is taken in local mode (tests: one machine, one process); on a cluster
    that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="agendario-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, group_mb: int = 0) -> DataFrame:
    """Cuts the lineage: writes ``df`` as Parquet in the shared folder and reads it again.

    The tables stay while results that read them may be used; whoever set ``spark.checkpoint.dir`` clears it after the job.

    ``group_mb`` bounds row groups where single rows are large, so that a task holds few of them; such
    rows are compressed better, too.
    """
    path = new_path(df.sparkSession, name)
    small = {"parquet.block.size": str(group_mb << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1", "compression": "zstd"} if group_mb else {}
    df.write.options(**small).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: At most so many keys are met by broadcast in ``met``.
MOST_HUBS = 50_000


def met(rows: DataFrame, keyed: DataFrame, key: str, total: int, least: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (one row per key; ``k``: how many rows have it), without hot tasks.

    Keys of more than ``total / MOST_HUBS`` rows (``least`` at least) are met by broadcast: fewer than ``MOST_HUBS``
    keys can be that frequent. All others are joined by a shuffle. At most ``MOST_HUBS`` rows in all have no more keys than
    that, and are met by broadcast at once.
    """
    from pyspark.sql import functions as F

    if total <= MOST_HUBS:
        return rows.join(F.broadcast(keyed.drop("k")), key)
    hot = max(least, total // MOST_HUBS)
    hubs = keyed.where(F.col("k") > hot).drop("k")
    near = rows.join(F.broadcast(hubs.select(key)), key, "left_anti").join(keyed.where(F.col("k") <= hot).drop("k"), key)
    return near.unionByName(rows.join(F.broadcast(hubs), key))


def ascii_lower(column):
    """A-Z lower-cased and nothing else (``lower`` would change other scripts too)."""
    from pyspark.sql import functions as F

    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
