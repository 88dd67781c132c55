"""Session factory and shared-storage helpers used across the library."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "evalyard", **conf: str) -> SparkSession:
    """A session with the settings the library assumes; cluster settings stay with the caller."""
    builder = SparkSession.builder.appName(app).config(map=CONF | conf)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``; on a local master one is set here when it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = os.path.join(tempfile.gettempdir(), f"evalyard-{os.getuid()}")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Folders that ``materialize`` has written in this process and that are still there.
_made: list[str] = []


def materialize(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(**options).parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def row_keys(df: DataFrame) -> tuple[DataFrame, str]:
    """(``df`` written once with a number of each row's own, that column's name): repeats and null ids stay apart."""
    key, taken = "row_key", {c.lower() for c in df.columns}
    while key in taken:
        key += "_"
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), "rows", compression="zstd"), key


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialize_stage(make: Callable[[], DataFrame], name: str = "stage") -> DataFrame:
    """``make``'s result written and read back, and what ``make`` has written on its way removed: the result doesn't need it any more."""
    mark = len(_made)
    out = materialize(make(), name)
    between = _made[mark:-1]
    del _made[mark:-1]
    for path in between:
        _remove(out.sparkSession, path)
    return out


def sweep(spark: SparkSession) -> None:
    """Remove what this application's ``materialize`` calls have left in the shared folder."""
    _remove(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    _made.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
