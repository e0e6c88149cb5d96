"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options the operators rely on.

    Times are naive UTC, and a JSON object that repeats a key keeps its last value.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only where no such folder is configured (tests, a laptop) a local one is made.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"Set {CHECKPOINT_DIR} to a folder all executors can reach.")
    return tempfile.mkdtemp(prefix=f"truerow-{name}-")


def staged(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written to a scratch folder and read back, and the folder, to be deleted when done."""
    spark = rows.sparkSession
    path = f"{scratch_dir(spark, name)}/rows"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Give back an intermediate folder that nothing reads any more."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)
