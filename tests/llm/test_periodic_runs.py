"""Periodic runs against brute force, and their defined cases."""

import os
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from hearth.llm.periodic_runs import diagonals, periodic_runs, runs_of, word_names
from tests.llm import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256"]


def found(w):
    return runs_of(word_names([[x.encode() for x in w]]))


@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 9)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_runs_of_repeated_blocks(blocks):
    w = "".join(b * n for b, n in blocks)
    assert found(w) == brute.runs(w)


def test_runs_of_random_words():
    rng = random.Random(7)
    for _ in range(1500):
        w = [rng.choice("abcde"[:rng.choice([1, 2, 3, 5])]) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            s, p = rng.randrange(len(w) + 1), rng.randint(1, 20)
            for i in range(s + p, min(len(w), s + rng.randint(1, 100))):
                w[i] = w[i - p]
        assert found(w) == brute.runs(w)


@pytest.mark.parametrize("w, expected", [
    ("", []), ("a" * 5, []), ("a" * 6, [(0, 6, 1)]), ("ab" * 3, []), ("ab" * 4, [(0, 8, 2)]),
    ("abababa", []), ("xabababababy", [(1, 10, 2)]), ("abc" * 4 + "ab", [(0, 14, 3)]),
    ("aaaaaabaaaaaab" * 4, brute.runs("aaaaaabaaaaaab" * 4))])
def test_small_cases(w, expected):
    assert found(w) == expected


def test_a_diagonal_is_emitted_where_it_ends():
    # two words 3 back, then a gap, then five: at scale 4, a match covers 4 words
    pos, lags = [3, 4, 20, 21, 22, 23, 24, 25], [3, 3, 3, 3, 3, 3, 3, 3]
    assert list(diagonals(pos, lags, 4, 6, 4)) == [(17, 12, 3)]


def test_long_repeats_take_time_in_proportion():
    took = []
    for n in (100_000, 400_000):
        begun = time.process_time()
        assert runs_of(np.zeros(n, np.int64)) == [(0, n, 1)]
        assert runs_of(np.arange(n) % 1000) == [(0, n, 1000)]
        took.append(time.process_time() - begun)
    assert took[1] < 10 * max(took[0], 0.05)


def test_documents_of_a_batch_never_share_a_run(spark):
    rows = [(k, "a a a") for k in range(50)] + [(50, "a " * 40), (51, None), (52, ""), (None, "b " * 9),
            (50, "a " * 40), (53, " \t\n "), (54, "x\x0by" * 8), (55, "a a " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"])
           for r in periodic_runs(df).collect()}
    assert got == {(i, len(w), tuple(brute.runs(w)), " ".join(
        x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in brute.runs(w))))
        for i, w in ((i, brute.words(t)) for i, t in rows)}


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, runs int, TEXTS string, n_words string, _doc int"
    assert periodic_runs(spark.createDataFrame([], schema)).collect() == []
    one = spark.createDataFrame([(1, "a a a a a a", 5, "q", "z", 3)], schema)
    assert [tuple(r) for r in periodic_runs(one).collect()] == [(1, 6, [(0, 6, 1)], "a")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(brute.periodic([tuple(r) for r in rows]), key=repr)
    got = E.queries()["op11_periodic_runs"](spark, SF).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected
    assert sum(r[1] for r in expected) > 10


def test_query_with_odd_rows(spark, tmp_path):
    rows = [(k, "one two three four five six seven eight nine ten " * (k % 7)) for k in range(200)]
    rows += [(None, "a " * 9), (14, None), (14, ""), (30, "w"), (30, "w")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = E.queries()["op11_periodic_runs"](spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, brute.periodic(rows)))
