"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "filigree", cores: int | str = "*", checkpoints: str | None = None) -> SparkSession:
    """A local session with the settings the library is tested under; ``checkpoints`` is its shared folder."""
    partitions = "8" if cores == "*" else str(cores)
    builder = SparkSession.builder if checkpoints is None else SparkSession.builder.config(CHECKPOINT_KEY, checkpoints)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would
    lose its files together with the executor that wrote them.
    """
    sc = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base.rstrip("/")
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="filigree-"))
    return sc.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps its staged tables."""
    return f"{shared_dir(spark)}/filigree/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder of this application."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Delete everything this application has staged; call it when no result is read any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(conf).delete(folder, True)


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are removed when it is written, not when the driver next collects garbage."""
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


def cut_lineage(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    What follows no longer depends on the executors that computed it, reads only
    the columns it needs, and plans with the table's real size. The shuffle files of the
    write are released with it.
    """
    path = fresh_path(df.sparkSession, "stage")
    with releasing_shuffles(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(*tables: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for ``tables``; nothing may read them any more."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        own = f"{run_folder(spark)}/stage-"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(own).toUri().getPath()):
                path.getFileSystem(conf).delete(path, True)
