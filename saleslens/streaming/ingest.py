"""Incremental load of landed CSV files into a Parquet folder (streaming form of A-01).

The file source picks up only new files; Spark's own file sink and the checkpoint make
each file count exactly once, also over restarts and failures. Keys are not checked here:
the landed folder is the input of ``load_table``, which does.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from saleslens.sources.files import CORRUPT_COL


def stream_load_csv(spark: SparkSession, source_dir: str, schema: T.StructType, target_dir: str,
                    checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the incremental load; with ``available_now`` it processes every file present
    and stops, otherwise it keeps running.

    ``checkpoint`` is a shared folder of this load alone; a run that names it again goes on
    where the last one ended. Lines that do not fit the schema keep their raw text in
    ``_corrupt_record``.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType())])
    lines = (spark.readStream.option("header", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", CORRUPT_COL).schema(full).csv(source_dir))
    writer = (lines.writeStream.format("parquet").outputMode("append")
              .option("path", target_dir).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
