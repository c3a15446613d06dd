"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC so dates never shift, AQE so join
# strategy and partition counts follow runtime sizes, skew-join splitting for
# hot keys (empty / sentinel siren values), and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tenderlake",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20, min_partitions: int = 8) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of landed data.

    AQE starts every shuffle with a partition for each ``partition_bytes`` of
    input and coalesces them at runtime down to its 64 MB advisory size when a
    stage is smaller, e.g. after a de-dup or a per-company aggregate.  Scans
    split files at 128 MB.  At 100 TB that is some 400,000 partitions; where
    the driver can't track so many, raise ``partition_bytes`` (reducers then
    sort and spill larger partitions, with the same results).
    """
    n = max(min_partitions, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 << 20),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    On a cluster the setting must name a distributed folder and is used as
    is; without it the call fails, because no machine's own folder is seen by
    the other machines.  Only a local session (tests) gets a private folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        path = tempfile.mkdtemp(prefix="tenderlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    app = spark.sparkContext.applicationId
    if app not in _CHECKPOINTS:  # Spark makes a new sub-folder at every call
        spark.sparkContext.setCheckpointDir(path)
        _CHECKPOINTS[app] = spark.sparkContext.getCheckpointDir()
    return _CHECKPOINTS[app] or path


#: The folder of its own that each application's checkpoints go to.
_CHECKPOINTS: dict[str, str | None] = {}


def _scratch_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or shared_dir(spark)
    shared_dir(spark)
    return f"{base.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the application's scratch folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the JVM for a path of any store Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Delete one scratch folder, by default all of this application's, its checkpoints included.

    Frames returned by queries read their scratch lazily, so whoever uses
    their rows calls this when done (the command line, the bench and the test
    session do).
    """
    root = _scratch_root(spark)
    if path is not None and not path.startswith(root + "/"):
        raise ValueError(f"{path} is no scratch folder")
    fs, p = hadoop_path(spark, path or root)
    fs.delete(p, True)
    if path is None and (own := _CHECKPOINTS.pop(spark.sparkContext.applicationId, None)):
        fs, p = hadoop_path(spark, own)
        fs.delete(p, True)


def materialize(df: DataFrame, name: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage recoverably: a lost executor loses nothing, and everything
    computed from the rows sees the same rows.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["build_session", "cluster_conf", "shared_dir", "scratch_path", "drop_scratch", "materialize",
           "hadoop_path", "DEFAULT_CONF"]
