"""Incremental intake: every new file of a folder once, with the stream's checkpoint as the load record."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.sources import loader


def stage_new_files(
    spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str, glob: str = "*", fmt: str = "parquet"
) -> int:
    """Stage the files that arrived since the last call as text, append them to ``target``, return the rows added.

    ``availableNow`` drains what is there and stops. A file is recorded in the checkpoint only when its batch is
    written; a batch that is repeated after a failure overwrites its own folder, so rows never double.
    """
    stream = (
        spark.readStream.schema(schema)
        .format(fmt)
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("*", F.col("_metadata.file_name").alias("metadata_arquivo_origem"))
    )

    added = []

    def write(batch: DataFrame, batch_id: int) -> None:
        text = batch.select(
            *[F.col(c).cast("string").alias(c) for c in batch.columns], F.current_timestamp().alias("metadata_data_carga")
        )
        text.write.mode("overwrite").parquet(f"{target}/lote={batch_id}")
        added.append(spark.read.schema(text.schema).parquet(f"{target}/lote={batch_id}").count())

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(added)


def load_new_archives(
    spark: SparkSession, folder: str, target: str, log_path: str, columns: list[str], table: str, checkpoint: str
) -> int:
    """Load the archives that arrived in ``folder`` since the last call, member by member; returns the number of events.

    The stream's offsets are the files seen; their contents are not read by it. Rows and log rows of a batch belong
    together: a batch that broke off at any point is repeated under its name, replaces the rows of its archives and its
    own log rows, and skips what another loader has finished meanwhile, so loaders may take turns. An archive that is
    delivered again under its name is left to ``loader.load_archives``.
    """
    files = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary")
    arrived = files.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path", "length")
    events = []

    def load(batch: DataFrame, number: int) -> None:
        name = f"{stream_name(checkpoint)}-{number}"
        events.append(loader.load_files(batch, target, log_path, columns, table, name).count())

    query = arrived.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(events)


def stream_name(checkpoint: str) -> str:
    """A name for the loads of a stream: that of its checkpoint, which alone tells its batches apart."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]
