"""Objects wait for the completion marker of their folder.

Keyed state: objects of a folder are held until its marker has arrived, before or after
them; from then on they pass. State survives restarts with the query's checkpoint. A
folder is dealt to several keys, each of which learns of the marker, so that the objects
of a large folder are held and released by several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from ..operators.routing import MARKER

#: Keys that one folder is dealt to.
SLOTS = 32
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Gate(StatefulProcessor):
    def __init__(self, schema: StructType) -> None:
        self._schema, self._names = schema, schema.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = handle.getValueState("open", StructType([StructField("open", BooleanType())]))
        self._held = handle.getListState("held", self._schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        is_open = self._open.exists()
        for frame in rows:
            is_marker = frame["is_marker"]
            own = frame.loc[~is_marker, self._names]
            if is_marker.any() and not is_open:
                is_open = True
                self._open.update((True,))
                held = list(self._held.get()) if self._held.exists() else []
                self._held.clear()
                if held:
                    yield pd.DataFrame([tuple(x) for x in held], columns=self._names)
            if len(own):
                if is_open:
                    yield own
                else:
                    self._held.appendList(list(own.itertuples(index=False, name=None)))

    def close(self) -> None:
        pass


def hold_until_ready(objects: DataFrame, marker: str = MARKER) -> DataFrame:
    """The objects (with ``key``) of folders that hold a marker, as soon as they do; markers themselves go."""
    objects.sparkSession.conf.set(_STORE, _ROCKS)
    base = F.substring_index("key", "/", -1)
    is_marker = base == marker
    folder = F.substr("key", F.lit(1), F.length("key") - F.length(base))
    slots = F.when(is_marker, F.sequence(F.lit(0), F.lit(SLOTS - 1))).otherwise(
        F.array(F.pmod(F.xxhash64("key"), F.lit(SLOTS)).cast("int")))
    keyed = objects.withColumn("is_marker", is_marker).withColumn("folder", folder).withColumn("slot", F.explode(slots))
    # Times go through the state as numbers.
    schema = StructType.fromDDL("path string, length bigint, at bigint, attempt int, turn bigint, key string")
    timed = keyed.withColumn("at", F.unix_micros("modificationTime")).drop("modificationTime")
    passed = timed.groupBy("folder", "slot").transformWithStateInPandas(
        statefulProcessor=_Gate(schema), outputStructType=schema, outputMode="Update", timeMode="None")
    return passed.select("path", "length", F.timestamp_micros("at").alias("modificationTime"), "attempt", "turn", "key")
