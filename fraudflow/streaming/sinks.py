"""Micro-batch table sinks (SNK2, ST8, ST11).

``table_sink(path)`` is a ``foreachBatch`` function that appends a batch to
a Parquet table partitioned by ``_batch``.  A replayed batch (after a
restart from the checkpoint) overwrites its own partition instead of
appending twice, so the sink is idempotent; ``_row`` numbers the rows of a
batch, and ``(_batch, _row)`` is the arrival key incremental readers use.
Empty batches write nothing.  A batch is one job, and nothing of it is held in
memory for a second one; it is written aside and renamed, so readers see all
of it or nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import path_exists, publish, remove

#: of a write that is published by a rename: tasks move their files themselves, and no marker is needed
ASIDE = {"partitionOverwriteMode": "static", "mapreduce.fileoutputcommitter.algorithm.version": "2",
         "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def table_sink(path: str, log: list | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, staged = batch.sparkSession, f"{path}.staged/{batch_id}"
        # partitioned, as then a batch without rows makes no folder; the number isn't
        # part of the plan, or else each batch would be compiled anew
        (batch.withColumns({"_row": F.monotonically_increasing_id(), "_batch": F.lit(0)})
              .write.mode("overwrite").options(**ASIDE).partitionBy("_batch").parquet(staged))
        rows = f"{staged}/_batch=0"
        full = path_exists(spark, rows)
        if log is not None:
            log.append((batch_id, spark.read.parquet(rows).count() if full else 0))
        if full:
            name = f"{path}/_batch={batch_id}"
            if path_exists(spark, name):
                remove(spark, name)
            publish(spark, rows, name)
        remove(spark, staged)
    return write


def read_table(spark, path: str, schema: str | None = None) -> DataFrame:
    """Read a sink table (``_batch`` comes back as a partition column); with
    ``schema`` a table that no batch has written yet is empty."""
    if schema and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    r = spark.read.schema(schema) if schema else spark.read
    return r.option("basePath", path).parquet(path)


def start_table_query(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                      trigger: dict | None = None, name: str | None = None, log=None, sink=None):
    """Start ``df.writeStream.foreachBatch(table_sink(path))``, or another
    ``sink``, with its own checkpoint (offsets, state, watermark survive
    restarts).

    The number of state partitions is the session's
    ``spark.sql.shuffle.partitions`` at the first start; give a stream of
    another width a session of its own (``spark.newSession()``).  An empty
    ``trigger`` starts a batch whenever the last has ended.
    """
    w = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
           .foreachBatch(sink or table_sink(path, log)))
    if name:
        w = w.queryName(name)
    trigger = {"availableNow": True} if trigger is None else trigger
    return (w.trigger(**trigger) if trigger else w).start()
