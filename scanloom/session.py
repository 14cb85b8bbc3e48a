"""Session helpers: settings, table access and cutting of lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Settings that hold at every size; cluster deployments override them at submit time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_WRITTEN: list[str] = []


def sized_conf(input_bytes: int, executor_cores: int) -> dict[str, str]:
    """Settings for a cluster job over so many bytes: scans of 256 MB, shuffles of about 128 MB a partition.

    Twice as many shuffle partitions as the input has blocks of 128 MB, as the operators shuffle up to a
    few times their input, and a multiple of the cores; adaptive execution joins small ones again.
    """
    mb = 1 << 20
    partitions = max(2 * executor_cores, -(-2 * input_bytes // (128 * mb)))
    partitions = -(-partitions // executor_cores) * executor_cores
    return DEFAULTS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * mb),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
    }


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    conf = DEFAULTS | {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(cores)} | extra
    spark = SparkSession.builder.master(f"local[{cores}]").appName("scanloom").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` (a file or a folder of files) of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Only a local session, where the setting is missing, gets a temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        folder = "file://" + tempfile.mkdtemp(prefix="scanloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame, drop: tuple[DataFrame, ...] = ()) -> DataFrame:
    """``df`` as a table written once in the shared folder: the plan starts afresh and survives lost executors.

    Loops cut every round. Unlike ``checkpoint()`` a written table carries no constraints of the plan
    it came from; in a loop of joins those multiply from round to round until the driver runs out of
    memory. Tables of earlier rounds that nothing reads any more are deleted with ``drop``.
    """
    out = stored(df, "cut")
    for old in drop:
        remove(old)
    return out


def cut_counted(df: DataFrame, counted: Column, drop: tuple[DataFrame, ...] = ()) -> tuple[DataFrame, int]:
    """``cut`` and the number of rows where ``counted`` holds, counted while they are written.

    A task that runs twice may count twice; that no row holds is exact.
    """
    seen = Observation()
    out = cut(df.observe(seen, F.count_if(counted).alias("n")), drop)
    return out, seen.get["n"]


def remove(df: DataFrame) -> None:
    """Deletes the table behind a result of ``cut`` or ``stored``; the frame can't be read afterwards."""
    path = getattr(df, "_written_to", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, label: str = "step") -> str:
    """A new folder name in the shared folder, which ``clear_scratch`` deletes."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def stored(df: DataFrame, label: str = "step", partitions: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used for wide intermediate tables that several branches read: the copy is columnar, so each
    branch reads only its columns, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def clear_scratch(spark: SparkSession) -> int:
    """Deletes every intermediate table this process wrote; call it when the results are written. Gives their number."""
    n = len(_WRITTEN)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        where = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        where.getFileSystem(conf).delete(where, True)
    return n
