"""Coercion and validation of files as they arrive, with the batch pipeline's expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.coerce import REJECT, Coercion, coerce, where


def read_stream(spark: SparkSession, folder: str, columns: Sequence[str], sep: str = ",", header: bool = True, files_per_trigger: int = 1000) -> DataFrame:
    """New csv files of a folder as texts."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.readStream.schema(schema).options(sep=sep, header=header, quote='"', escape='"', maxFilesPerTrigger=files_per_trigger).csv(folder)


def write_stream(df: DataFrame, plan: dict[str, Coercion], accepted: str, rejected: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Types every micro-batch and appends accepted and rejected rows to two parquet folders.

    A batch that is run again after a failure overwrites its own part, so rows aren't doubled.
    """

    def save(batch: DataFrame, number: int) -> None:
        typed = coerce(batch, plan)
        where(typed, F.col(REJECT).isNull()).drop(REJECT).write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        where(typed, F.col(REJECT).isNotNull()).select(REJECT).write.mode("overwrite").parquet(f"{rejected}/batch={number}")

    writer = df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def dedup_stream(df: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row of each key within a delay of event time; state older than that is dropped."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
