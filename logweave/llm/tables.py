"""Reading tables and small helpers on frames that the operators share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text in one batch of documents. A batch is what one Python call holds.
BATCH_BYTES = 4 << 20
#: Bytes of text in one partition of batches.
PART_BYTES = 16 << 20


def others(columns: Iterable[str], made: Iterable[str]) -> list[str]:
    """The columns to carry along: what an operator makes replaces a column of the same name."""
    taken = {x.lower() for x in made}
    return [c for c in columns if c.lower() not in taken]


def free(columns: Iterable[str], name: str) -> str:
    """A name like `name` that none of the columns has, in whatever case."""
    taken = {x.lower() for x in columns}
    while name.lower() in taken:
        name += "_"
    return name


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    A folder of this machine is set only where that is unset, and only if Spark runs in this machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame, computed once, with its lineage cut, in the shared folder of the session."""
    _shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def stored(frame: DataFrame) -> DataFrame:
    """The frame written as Parquet in the shared folder and read again."""
    path = f"{_shared_folder(frame.sparkSession)}/table-{uuid.uuid4()}"
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def release(frame: DataFrame) -> None:
    """Let Spark drop the shuffle files of what is done: it does so once its handles are collected as garbage."""
    gc.collect()
    frame.sparkSession.sparkContext._jvm.System.gc()


def text_bytes(frame: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: sizes batches and buckets, never which rows count."""
    return frame.agg(F.sum(F.octet_length(column))).first()[0] or 0


def partitions(spark: SparkSession, size: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(size / PART_BYTES))
