"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import scratch_path, shared_dir

PACKAGE = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def ship(spark: SparkSession) -> None:
    """Hand the package's source to the executors, once per application.

    Tasks can then import it wherever the driver was started and whatever is
    installed on the workers.  A package that came in an archive was shipped by
    whoever submitted the job.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED or not PACKAGE.is_dir():
        return
    # Spark's own folder of served files: there until the application ends
    archive = f"{SparkFiles.getRootDirectory()}/shipped/{PACKAGE.name}_source"
    context.addPyFile(shutil.make_archive(archive, "zip", PACKAGE.parent, PACKAGE.name))
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` of a function that uses this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Cuts lineage the recoverable way: a lost executor loses nothing, and what
    is computed from the rows (ranks, samples) sees the same rows every time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that ``spark.checkpoint.dir`` names."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (names compare caselessly)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (NULL id: NULL)."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds
