"""What the streaming jobs keep: settings of keyed state, and versioned state tables.

Versioned tables are for ``foreachBatch`` jobs: each batch reads the newest complete
version below its own id and writes a version under its own id, replacing what a failed
attempt may have left. Running a batch again therefore starts from the same state and
ends in the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline.session import delete


def ddl(layout: dict[str, str]) -> str:
    """Column names and types as a schema string."""
    return ", ".join(f"{name} {kind}" for name, kind in layout.items())


_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with its own columns needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)


class Versions:
    """Versions of one table below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, layout: dict[str, str]) -> None:
        self._spark, self._folder, self._columns = spark, folder, list(layout)
        self._schema = ddl(layout)

    def _listed(self) -> list[int]:
        jvm = self._spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._folder)
        fs = path.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("v=") and fs.exists(done):
                found.append(int(name[2:]))
        return found

    def before(self, batch_id: int) -> DataFrame:
        """State as the batch found it; empty before the first batch."""
        older = [v for v in self._listed() if v < batch_id]
        if not older:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(f"{self._folder}/v={max(older)}")

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Write the state after the batch, and drop versions no retry can need."""
        rows.select(*self._columns).write.mode("overwrite").parquet(f"{self._folder}/v={batch_id}")
        for version in self._listed():
            # The batch before this one is committed, so its input is not needed.
            if version < batch_id - 1:
                delete(self._spark, f"{self._folder}/v={version}")
