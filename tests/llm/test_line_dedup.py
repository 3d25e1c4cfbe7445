"""Line dedup against brute force: the index, and the defined cases."""

import random

import numpy as np
import pytest

from hearth.llm.line_dedup import HASH, build_levels, line_dedup, pack, unpack
from tests.llm import brute


def keys_of(n, seed=0):
    rng = np.random.default_rng(seed)
    keys = np.zeros(n, HASH)
    keys["lo"] = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
    keys["hi"] = rng.integers(0, 2**32, n)
    return keys


@pytest.mark.parametrize("n", [1, 2, 3, 100, 40_000])
def test_index_is_minimal_and_perfect(n):
    keys = keys_of(n)
    counts = np.arange(n) + 1
    shard = unpack(*pack(keys, counts, least=10), 10)
    assert sorted(shard.slots(keys).tolist()) == list(range(n))
    assert sum(int(b.sum()) for b in shard.levels) == n
    assert (shard.count(keys) == np.minimum(counts, 10)).all()
    assert shard.counts.dtype == np.uint8 and shard.prints.dtype == np.uint16


def test_index_tells_keys_that_share_half():
    keys = np.zeros(600, HASH)
    keys["lo"], keys["hi"] = np.arange(600) // 2, np.arange(600) % 2
    shard = unpack(*pack(keys, np.arange(600), 1000), 1000)
    assert (shard.count(keys) == np.arange(600)).all()


def test_foreign_lines_and_repeated_keys_are_refused():
    shard = unpack(*pack(keys_of(1000), np.ones(1000), 10), 10)
    with pytest.raises(ValueError, match="not in its shard"):
        shard.count(keys_of(1000, seed=1))
    with pytest.raises(ValueError, match="not distinct"):
        build_levels(np.zeros(2, HASH))


def check(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    options = {k: v for k, v in kw.items() if k != "shard_keys"}
    got = [tuple(r) for r in line_dedup(df, **kw).collect()]
    assert sorted(got, key=repr) == sorted(brute.lines_kept(rows, **options), key=repr)
    return got


def test_random_lines(spark):
    rng = random.Random(3)
    common = [f" Line {k}\t" for k in range(30)]
    rows = []
    for i in range(300):
        lines = [rng.choice(common) if rng.random() < .5 else f"own {i} {rng.random()}"
                 for _ in range(rng.randrange(9))]
        rows.append((i, "\n".join(x.upper() if rng.random() < .3 else x for x in lines)))
    got = check(spark, rows, shard_keys=64)
    assert sum(r[2] for r in got) > 200
    check(spark, rows, least=40, chars=7)


def test_defined_cases(spark):
    rows = [(k, "Same\r\n\n  \nsAME \x0b\nÄ line\nÄ LINE") for k in range(9)]
    rows += [(9, "same"), (10, None), (11, ""), (None, "same\nleft"), (12, "\n"), (12, "\n"),
             (13, " same"), (14, "same\n" * 5), (15, "x" * 300_000 + "\nsame")]
    check(spark, rows)
    check(spark, rows[:8], least=9)


def test_threshold_counts_documents_not_lines(spark):
    rows = [(k, "a\na\na\nb") for k in range(9)]
    assert all(r[2] == 0 for r in check(spark, rows))
    assert all(r[2] == 4 for r in check(spark, [*rows, (9, "B\na")]) if r[0] != 9)


def test_many_copies_of_a_text(spark):
    rows = [(1, "hot line\nother line\nthird")] * 3000 + [(k, f"own {k}\nhot line") for k in range(50)]
    got = check(spark, rows, parts=7)
    assert {r[3] for r in got if r[0] == 1 and r[1] == 3} == {""}


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, n_lines int, gone string, _k1 int, kept string"
    assert line_dedup(spark.createDataFrame([], schema)).collect() == []
    one = spark.createDataFrame([(1, "a\nb", 5, "q", 3, "z")], schema)
    assert [tuple(r) for r in line_dedup(one, least=1).collect()] == [(1, 2, 2, "")]
