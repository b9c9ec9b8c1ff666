"""Session-level helpers shared by every plan: tables, lineage cuts, dealing rows out."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the shared one the cluster names, or a temporary one on a single machine.

    Raises RuntimeError on a cluster that names none, since its executors couldn't read each
    other's local folders.
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spanloom-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


_WRITTEN: dict[str, SparkSession] = {}


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read that: a cut of the lineage that is
    columnar and survives the loss of executors. The table is removed by ``discard`` or at exit."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    _WRITTEN[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the tables of ``written`` that ``df`` reads; nothing may be computed from it any more."""
    read = df.inputFiles()
    for path in list(_WRITTEN):
        if any(path.rpartition("/")[2] in f for f in read):
            _remove(path)


def _remove(path: str) -> None:
    spark = _WRITTEN.pop(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _remove_all() -> None:
    for path in list(_WRITTEN):
        try:
            _remove(path)
        except Exception:  # noqa: BLE001  the session has ended before
            return


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out anew if a small input has fewer partitions than there are cores.

    A large input has many splits and isn't touched; one file of one row group would otherwise
    keep a Python stage on a single core. Behind a shuffle the rows are dealt out over as many
    partitions as the session shuffles to; that is seen in the plan, so nothing is computed here.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    execution = df._jdf.queryExecution()
    if "Exchange" in execution.executedPlan().toString():
        return df.repartition(max(2 * cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return df if execution.toRdd().getNumPartitions() >= cores else df.repartition(2 * cores)
