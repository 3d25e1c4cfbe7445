"""ST1: two available-now runs over two file slices equal one batch merge,
replaying the same files changes nothing, and an upsert rewrites only the
buckets it touches."""

import os

from hearth.operators import merge as mg
from hearth.session import fresh_subdir
from hearth.streaming.upsert import run_stream_upsert_on_slices, stream_upsert
from tests.conftest import rows

SCHEMA = "k int, v string, ts int"


def test_two_runs_equal_batch_merge(spark):
    t = spark.createDataFrame([(i, "t", 1) for i in range(10)], SCHEMA)
    s = spark.createDataFrame([(i, "s", 2) for i in range(5, 15)] + [(6, "s2", 3)], SCHEMA)
    streamed = run_stream_upsert_on_slices(spark, t, s, "k", "ts")
    assert rows(streamed) == rows(mg.merge_upsert(t, s, "k", ts="ts"))


def test_rerun_without_new_files_is_noop(spark):
    root = fresh_subdir(spark, "stream-test")
    table = mg.BucketedTable(spark, f"{root}/t", "k", 4)
    spark.createDataFrame([(1, "a", 1)], SCHEMA).write.parquet(f"{root}/in")
    for _ in range(2):
        stream_upsert(spark, f"{root}/in", spark.createDataFrame([], SCHEMA).schema, table,
                      "ts", f"{root}/ckpt").awaitTermination()
    assert rows(table.read().select("k", "v", "ts")) == [(1, "a", 1)]


def test_bucketed_upsert_touches_only_hit_buckets(spark):
    root = fresh_subdir(spark, "bucket-test")
    table = mg.BucketedTable(spark, f"{root}/t", "k", 8)
    base = spark.createDataFrame([(i, "t", 1) for i in range(200)], SCHEMA)
    table.upsert(base, ts="ts")
    before = {d: sorted(os.listdir(f"{root}/t/{d}")) for d in os.listdir(f"{root}/t")
              if d.startswith("bucket=")}
    change = spark.createDataFrame([(3, "new", 2), (1000, "ins", 2)], SCHEMA)
    table.upsert(change, ts="ts", keep_newer_target=True)
    after = {d: sorted(os.listdir(f"{root}/t/{d}")) for d in os.listdir(f"{root}/t")
             if d.startswith("bucket=")}
    changed = {d for d in after if before.get(d) != after[d]}
    assert 1 <= len(changed) <= 2                        # only the buckets of keys 3 and 1000
    got = rows(table.read().select("k", "v", "ts"))
    want = rows(mg.merge_upsert(base, change, "k", ts="ts"))
    assert got == want
    table.upsert(change, ts="ts", keep_newer_target=True)   # replay: unchanged
    assert rows(table.read().select("k", "v", "ts")) == want
