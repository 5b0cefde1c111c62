"""Size checks that decide between a single-task plan and a distributed one."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SINGLE_TASK_CONF = "spark.marketlens.singleTaskBytes"
SINGLE_TASK_DEFAULT = 64 * 1024 * 1024


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of all sources a plan reads, taken from the optimizer's statistics. Runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits_one_task(df: DataFrame) -> bool:
    """Whether everything the plan reads may be gathered by one task.

    The bound covers the input, hence also any one group of it, however skewed the keys are.
    """
    limit = int(df.sparkSession.conf.get(SINGLE_TASK_CONF, str(SINGLE_TASK_DEFAULT)))
    return scanned_bytes(df) <= limit


def checkpoint_dir_known(spark: SparkSession) -> bool:
    """Use the shared folder the cluster names; fall back to a local one in local mode only."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return True
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not folder and context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="marketlens-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if folder:
        context.setCheckpointDir(folder)
    return bool(folder)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which every executor reaches; for written tables of one run."""
    if not checkpoint_dir_known(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a frame that several jobs read in the shared folder and read it back.

    The frame is computed once, its columns can be pruned and its statistics are the real ones. A
    cluster must name the folder in spark.checkpoint.dir.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_workers_import(spark: SparkSession) -> None:
    """Python workers of this session find the package beside this one's parent folder, where they have none of their own.

    Call it before a function that refers to the package becomes part of a plan.
    """
    root, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [known.get("PYTHONPATH"), root]))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash the rows over all shuffle partitions, ahead of work that is heavy per row.

    A fixed number of partitions keeps the runtime from merging them just because the rows are few,
    and later groupings by the key need no further shuffle.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), key)


def join_small(df: DataFrame, side: DataFrame, keys: str | list[str], how: str = "left") -> DataFrame:
    """Join an aggregate of a large table to that table without moving the table, where the aggregate is small.

    The aggregate is stored, so that its real size is known: its static estimate is the size of the table it comes from.
    Beyond the bound of broadcast_if_small both sides are shuffled, and adaptive execution splits a hot key.
    """
    return df.join(broadcast_if_small(cut_lineage(side)), keys, how)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Mark a narrow frame for broadcasting if its stored bytes and rows allow; else the join shuffles.

    Call it on a frame whose lineage is cut, so that its bytes are known and counting reads footers only.
    """
    return F.broadcast(df) if scanned_bytes(df) <= max_bytes and df.count() <= max_rows else df
