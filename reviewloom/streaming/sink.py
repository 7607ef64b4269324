"""Running a stream over the data at hand, into a table.

Every micro-batch replaces its own epoch folder, so a batch that is run again after a failure
leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from reviewloom.plans.storage import scratch_path

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_IN_MEMORY = "HDFSBackedStateStoreProvider"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over a Parquet file or folder with the schema of its present content."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # As a plain path a single file would be taken for a base folder; as a pattern it is not.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query takes its state store from the session when it starts."""
    named = spark.conf.get(_STATE_STORE)
    if not named.endswith(_IN_MEMORY):
        yield
        return
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_STATE_STORE, named)


def epoch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    def write(batch: DataFrame, epoch: int) -> None:
        result = batch if transform is None else transform(batch)
        result.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def run_available(
    stream: DataFrame,
    name: str,
    schema: StructType,
    mode: str = "update",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Processes all present input and returns what was written, with its ``epoch``.

    State may have a key per run or device, so it is kept on disk rather than on the heap, unless the session
    names a state store of its own; the setting is put back afterwards. With a ``checkpoint`` the stream goes on
    where the last one with it stopped, and only what is new is written and returned.
    """
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    with _state_on_disk(spark):
        query = (
            stream.writeStream.outputMode(mode)
            .foreachBatch(epoch_writer(out, transform))
            .option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-state"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    full = StructType([*schema.fields]).add("epoch", IntegerType())
    try:
        return spark.read.schema(full).parquet(out)
    except AnalysisException as error:
        # Without input since the checkpoint there is no batch.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def newest_rows(written: DataFrame, keys: list[str]) -> DataFrame:
    """The last update of every key."""
    values = F.struct(*[F.col(c) for c in written.columns if c not in (*keys, "epoch")])
    return (
        written.groupBy(*keys)
        .agg(F.max_by(values, F.col("epoch")).alias("__last"))
        .select(*keys, "__last.*")
    )
