"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Ship the package's few Python helpers inside the plan, so that executors need
# no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

SETTINGS = {
    # Timestamps are UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in a key=value line keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # A repeated key in a JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A 26-column projection fused into one generated method is too large for
    # the JVM's compiler (8,000 bytecodes at most, far less to be compiled well)
    # and stays interpreted. Past this size Spark runs the operators unfused, in
    # small methods: 7 to 15 times faster on wide projections.
    "spark.sql.codegen.hugeMethodLimit": "4000",
    "spark.sql.adaptive.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings above on ``spark`` and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names a shared folder in ``spark.checkpoint.dir``, or the program
    has set one; only where both are missing and Spark runs in this machine alone
    is a temporary folder of this machine used.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/logweave-{label}-{uuid.uuid4().hex}"
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"logweave-{label}-")


_kept: list[DataFrame] = []


def kept(df: DataFrame) -> DataFrame:
    """``df`` cached until the enclosing ``released`` ends (outside of one, until the session ends)."""
    _kept.append(df.persist())
    return _kept[-1]


def counted(df: DataFrame) -> DataFrame:
    """``df`` kept and computed now, so that a join with it is planned by the size that it has."""
    held = kept(df)
    held.count()
    return held


@contextmanager
def released() -> Iterator[None]:
    """Gives back what is cached inside, so that a long run does not pile it up."""
    before = len(_kept)
    try:
        yield
    finally:
        while len(_kept) > before:
            _kept.pop().unpersist()
