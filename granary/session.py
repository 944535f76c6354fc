"""Session settings and shared scratch storage."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Splitting skewed join partitions pays off even when it costs another shuffle further up.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
CHECKPOINT_DIR = "spark.checkpoint.dir"
_SHIPPED: dict[str, str] = {}


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the planner settings the plans count on; sizes such as partition counts stay the cluster's own."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("granary")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return tuned(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder in the storage all executors share: the cluster's checkpoint folder, else one below the warehouse.

    The folder goes when the application ends; until then lazy readers may need it.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    folder = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    files, path = _hadoop(spark, folder)
    files.mkdirs(path)  # only what exists can be marked
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """Write once to shared storage, then scan: cuts the lineage, and a lost executor costs only what it was reading.

    by: a column of few values whose rows get a folder each; filters on it skip the other folders.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, purpose)}/rows"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, taken: list[str]) -> str:
    """A column name like this one that a table does not have."""
    while name.lower() in (t.lower() for t in taken):
        name += "_"
    return name


def _hadoop(spark: SparkSession, folder: str):
    """(file system, path) of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def shipped(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once an application; functions that run in Python workers need it there."""
    if _SHIPPED.get("to") != spark.sparkContext.applicationId:
        packed, root = io.BytesIO(), Path(__file__).resolve().parent
        with zipfile.ZipFile(packed, "w") as archive:
            for module in sorted(root.rglob("*.py")):
                archive.write(module, module.relative_to(root.parent))
        target = f"{scratch_dir(spark, 'package')}/{root.name}.zip"
        files, path = _hadoop(spark, target)
        out = files.create(path)
        out.write(packed.getvalue())
        out.close()
        spark.sparkContext.addPyFile(target)
        _SHIPPED["to"] = spark.sparkContext.applicationId
    return spark
