"""ST1: incremental upsert as an available-now Structured Streaming query.

New extract files land in an input folder; each trigger processes only the
files not seen before (the stream checkpoint plays the high-watermark
role), keeps the newest row per key of the micro-batch (WN2) and merges it
into a bucketed target (MG1) with late-row protection: a target row is kept
when its timestamp is not older than the incoming one.  Only the buckets a
micro-batch touches are rewritten; a batch of scattered keys touches all.

``foreachBatch`` records a marker per applied batch id under the stream
checkpoint; a batch replayed after a failure between the table write and
the checkpoint commit is skipped, and a batch interrupted mid-write is
re-applied — the merge is idempotent (NULL keys are refused), so both
converge to the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.operators.merge import BucketedTable
from hearth.session import fresh_subdir


def stream_upsert(spark: SparkSession, input_dir: str, schema, table: BucketedTable,
                  ts: str, checkpoint: str):
    """Start the query; returns the ``StreamingQuery`` (``availableNow``:
    it stops by itself once the files present at start are processed)."""
    markers = f"{checkpoint.rstrip('/')}/_applied"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{markers}/{batch_id}")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(p):                       # batch already applied
            return
        table.upsert(batch, ts=ts, keep_newer_target=True)
        fs.mkdirs(p)

    stream = spark.readStream.schema(schema).parquet(input_dir)
    return (stream.writeStream.foreachBatch(upsert)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_stream_upsert_on_slices(spark: SparkSession, target: DataFrame, source: DataFrame,
                                key: str, ts: str, buckets: int = 16) -> DataFrame:
    """Drive ST1 over two file slices: the target rows arrive first, the
    change rows second; two ``availableNow`` runs must equal one batch merge."""
    root = fresh_subdir(spark, "stream")
    input_dir, ckpt = f"{root}/input", f"{root}/checkpoint"
    table = BucketedTable(spark, f"{root}/target", key, buckets)
    for part in (target, source):
        part.write.mode("append").parquet(input_dir)
        stream_upsert(spark, input_dir, target.schema, table, ts, ckpt).awaitTermination()
    return table.read()
