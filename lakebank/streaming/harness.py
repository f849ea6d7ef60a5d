"""Drive a stream over data that arrives in parts (tests and registered
stream queries).

Each part is written as new files into a source folder on the shared
checkpoint location, then the stream runs with ``availableNow`` and stops;
the next part resumes from the same checkpoint. This is how a scheduled
incremental job runs in production.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from lakebank.session import scratch_path


def run_in_parts(spark: SparkSession, df: DataFrame, parts: Sequence[Column], name: str,
                 build: Callable[[DataFrame], DataFrame] | None = None,
                 start: Callable[[str, str], object] | None = None) -> tuple[str, str]:
    """Write each part into a fresh source folder, then run the stream once.

    Either ``build`` (streaming DataFrame -> streaming DataFrame, written in
    append mode to a parquet sink) or ``start``
    (``(source_dir, checkpoint) -> StreamingQuery``) must be given. Returns the
    sink's path and the checkpoint's.
    """
    src = scratch_path(spark, f"{name}-src")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    sink = scratch_path(spark, f"{name}-out")
    for p in parts:
        df.filter(p).write.mode("append").parquet(src)
        if start is not None:
            q = start(src, ckpt)
        else:
            stream = spark.readStream.schema(df.schema).parquet(src)
            q = (build(stream).writeStream.format("parquet").option("path", sink)
                 .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()          # to the end, however long it takes; a failed query raises here
    return sink, ckpt
