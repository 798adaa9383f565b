"""Word jobs, push/pull, changelog, learner and profiles on small fixtures."""

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import changelog, kv, learn, partitioning, profile, textjobs
from millrace.operators.changelog import compact, fold, get, replay


# --- texts ----------------------------------------------------------------

DOCS = [(0, "a b a"), (1, "b c"), (2, ""), (16, "b  a\nz"), (17, "b")]


def docs(spark):
    return spark.createDataFrame(DOCS, "id long, text string")


def test_word_count_and_lines(spark):
    counts = textjobs.word_count(docs(spark), "text")
    assert rows(counts) == [("a", 3), ("b", 4), ("c", 1), ("z", 1)]
    lines = textjobs.merged_lines(counts.selectExpr("word AS key", "string(count) AS value"))
    assert [r[0] for r in lines.collect()] == ["a: 3", "b: 4", "c: 1", "z: 1"]
    top = textjobs.top_counts(counts, 3)
    assert [tuple(r) for r in top.collect()] == [("z", 1), ("a", 3), ("b", 4)]


@pytest.mark.parametrize("bits", [0, 2, 14])
def test_index_segments_join_to_the_whole_list(spark, bits):
    index = textjobs.inverted_index(docs(spark), "id", "text", bits=bits).orderBy("word", "segment").collect()
    whole, n_docs = {}, {}
    for r in index:
        whole.setdefault(r.word, []).extend(r.docs.split(","))
        n_docs[r.word] = r.n_docs
    name = "doc-{:019d}".format
    assert whole == {"a": [name(0), name(16)], "b": [name(0), name(1), name(16), name(17)],
                     "c": [name(1)], "z": [name(16)]}
    assert n_docs == {k: len(v) for k, v in whole.items()}


def test_index_by_name(spark):
    named = spark.createDataFrame([("f10", "b a"), ("f9", "b"), ("f1", "a b b")], "name string, text string")
    got = textjobs.inverted_index_by_name(named, "name", "text", bits=40)
    assert rows(got.select("word", "n_docs", "docs")) == [("a", 2, "f1,f10"), ("b", 3, "f1,f10,f9")]


def test_top_index_drops_lines_with_the_text(spark):
    got = textjobs.top_index(docs(spark), "id", "text", k=5)
    assert [r.word for r in got.collect()] == ["c"]


def test_numbers_in_are_keys_out(spark):
    text = "\n".join(map(str, range(2000)))
    df = spark.createDataFrame([(0, text)], "id long, text string")
    got = [r.key for r in textjobs.distinct_keys(df, "text").collect()]
    assert got == sorted(map(str, range(2000)))


def test_user_job_with_a_hot_key(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        texts = [("f%d" % i, "the the w%d" % (i % 7)) for i in range(1000)]
        df = spark.createDataFrame(texts, "name string, contents string").repartition(4)
        mapper = lambda n, c: [(w, "1") for w in c.split()]
        job = textjobs.run_job(df, "name", "contents", mapper, lambda k, v: str(len(v)),
                               lambda k, v: str(sum(map(int, v))), 3)
        got = {r.key: int(r.value) for r in job.collect()}
        want = {"the": 2000} | {f"w{i}": len([x for x in range(1000) if x % 7 == i]) for i in range(7)}
        assert got == want
        pairs = textjobs.map_files(df, "name", "contents", mapper)
        assert pairs.count() == 3000
        reduced = textjobs.reduce_groups(pairs, lambda k, v: str(len(v)), lambda k, v: str(sum(map(int, v))))
        assert {r.key: int(r.value) for r in reduced.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# --- push and pull --------------------------------------------------------

def test_scalar_pushes_and_pull(spark):
    pushes = spark.range(1000).crossJoin(spark.range(50).toDF("p")).selectExpr("id AS key", "double(id) AS val")
    store = kv.push_sum(pushes)
    assert store.where("val <> key * 50").count() == 0 and store.count() == 1000
    keys = spark.createDataFrame([(3,), (5000,)], "key long")
    assert rows(kv.pull(keys, store)) == [(3, 150.0), (5000, 0.0)]
    with pytest.raises(Exception, match="key 5000"):
        kv.pull_strict(keys, store).collect()
    assert rows(kv.pull_strict(keys.where("key = 3"), store)) == [(3, 150.0)]


def test_vector_pushes(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0])], "key int, vec array<double>")
    sums = kv.push_vectors(df, ["key"], "vec")
    assert rows(sums) == [(1, 0, 4.0, 2), (1, 1, 6.0, 2), (2, 0, 5.0, 1)]
    assert rows(kv.fold_vectors(sums, ["key"])) == [(1, [4.0, 6.0]), (2, [5.0])]
    with pytest.raises(Exception, match="vector sizes differ"):
        kv.push_vectors(df, ["key"], "vec", length=2).collect()


def test_match_assign(spark):
    dst = spark.createDataFrame([(1, 10), (2, None), (3, 7)], "key long, val long")
    src = spark.createDataFrame([(1, 5), (2, 6), (9, 1)], "key long, val long")
    assert rows(kv.match_assign(dst, src, "MINUS")) == [(1, 5, True), (2, -6, True), (3, 7, False)]
    assert rows(kv.match_assign(dst.where("key = 2"), src.where("key = 9"))) == [(2, 0, False)]
    dst = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "key long, val array<double>")
    src = spark.createDataFrame([(1, [3.0, 4.0])], "key long, val array<double>")
    assert rows(kv.match_assign(dst, src, "TIMES", k=2)) == [(1, [3.0, 8.0], True), (2, [0.0, 0.0], False)]


@pytest.mark.parametrize("bits", [1, 3, 14])
def test_push_handler_keeps_order(spark, bits):
    data = [(k, seq, float(seq % 10)) for seq, k in enumerate([1, 2, 1, 1, 2, 1, 1, 1, 2, 1] * 10)]
    df = spark.createDataFrame(data, "key long, seq long, val double")
    last = kv.push_handled(df, lambda v: v[-1], lambda v: v[-1], bits=bits)
    assert rows(last) == [(1, 9.0), (2, 8.0)]
    total = kv.push_handled(df, sum, sum, bits=bits)
    assert rows(total) == [(k, sum(v for kk, _, v in data if kk == k)) for k in (1, 2)]


def test_key_ranges_cover_everything(spark):
    top = partitioning.MAX_KEY
    for n in (1, 3, 7):
        ranges = partitioning.key_ranges(n)
        assert ranges[0][0] == 0 and ranges[-1][1] == top + 1
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
        keys = [0, top // 2, top] + [r[0] for r in ranges] + [r[1] - 1 for r in ranges]
        df = spark.createDataFrame([(str(k),) for k in keys], "k string").selectExpr("cast(k AS decimal(20,0)) AS k")
        for k, s in df.select("k", partitioning.range_slice(F.col("k"), n)).collect():
            assert ranges[s][0] <= int(k) < ranges[s][1]


def test_balanced_slices(spark):
    parts = partitioning.repartition_balanced(spark.range(1000), "id", 4)
    sizes = [r[0] for r in parts.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 1000 and len(sizes) > 1


# --- changelog ------------------------------------------------------------

LOG = "log_index long, op string, key string, value string, client long, request_id long"


def brute_fold(log):
    store, seen = {}, {}
    for _, op, key, value, client, request in sorted(log):
        if client in seen and seen[client] >= request:
            continue
        seen[client] = request
        if op == "Put":
            store[key] = value
        elif op == "Append":
            store[key] = store.get(key, "") + value
    return store


def joined(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.key, r.segment, r.piece)):
        out[r.key] = out.get(r.key, "") + r.value
    return out


def test_changelog_fixture(spark):
    log = [(0, "Put", "k", "x", 1, 0), (1, "Append", "k", "y", 1, 1), (2, "Append", "k", "y", 1, 1),
           (3, "Append", "k", "z", 2, 0), (4, "Put", "k", "OLD", 1, 0), (5, "Put", "m", "q", 2, 1)]
    df = spark.createDataFrame(log, LOG)
    assert rows(fold(df)) == [("k", 0, 0, "xyz"), ("m", 0, 0, "q")]
    keys = spark.createDataFrame([("k",), ("none",)], "key string")
    assert rows(get(df, keys)) == [("k", 0, 0, "xyz"), ("none", 0, 0, "")]
    assert rows(get(df, keys, upto=1)) == [("k", 0, 0, "xy"), ("none", 0, 0, "")]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["Put", "Append", "Append", "Get"]), st.sampled_from("ab"),
                          st.integers(0, 2), st.integers(0, 12)), min_size=1, max_size=30),
       st.integers(-1, 30), st.integers(1, 3))
def test_changelog_properties(spark, ops, cut, bits):
    log = [(i, op, key, f"<{i}>", client, request) for i, (op, key, client, request) in enumerate(ops)]
    df = spark.createDataFrame(log, LOG)
    want = brute_fold(log)
    whole = fold(df, bits)
    assert joined(whole) == want
    assert rows(replay(spark, compact(df, cut, bits), df, bits)) == rows(whole)


def test_pieces_of_bounded_bytes(spark, monkeypatch):
    rnd = random.Random(5)
    log = [(i, rnd.choice(["Put", *["Append"] * 9]), rnd.choice("ab"), f"<{i}>" + "é" * rnd.randint(0, 40), 0, i) for i in range(120)]
    df = changelog.dedupe(spark.createDataFrame(log, LOG))
    parts = [changelog.fold_segments(df.where(cond), 5, 100).withColumn("part", F.lit(n))
             for n, cond in enumerate(("log_index < 50", "log_index BETWEEN 50 AND 90", "log_index > 90"))]
    for folded in (changelog.fold_segments(df, 5, 100), changelog.merge_parts(parts[0].union(parts[1]).union(parts[2]), 100)):
        assert joined(changelog.live(folded, changelog.puts_of(folded))) == brute_fold(log)
        sizes = [len(r["text"].encode()) for r in folded.collect()]
        assert max(sizes) <= 100 + 2 * 85 + 100 and folded.where("piece > 0").count() > 5


def test_append_order(spark):
    log = [(i, "Append", "k", f"x {i % 2} {i} y", i % 2, i) for i in range(20)]
    assert rows(changelog.append_order(spark.createDataFrame(log, LOG), bits=2)) == [
        ("k", 0, 10, True), ("k", 1, 10, True)]
    swapped = [(9, *log[0][1:4], 0, 9), *log[1:9], (0, *log[8][1:4], 0, 0), *log[10:]]
    got = dict((r.client, r.in_order) for r in changelog.append_order(
        spark.createDataFrame(swapped, LOG), bits=2).collect())
    assert got[0] is False
    twice = [*log, (20, "Append", "k", "x 1 3 y", 1, 50)]
    got = dict((r.client, r.in_order) for r in changelog.append_order(
        spark.createDataFrame(twice, LOG), bits=2).collect())
    assert got == {0: True, 1: False}


def test_committed_changes(spark):
    log = [(0, "T1", "begin", None, None), (1, "T1", "update", "a", 3), (2, "T1", "update", "b", 4),
           (3, "T2", "begin", None, None), (4, "T2", "update", "c", 21), (5, "T1", "abort", None, None),
           (6, "T2", "update", "d", 22), (7, "T2", "commit", None, None), (8, "T3", "update", "c", 99)]
    df = spark.createDataFrame(log, "lsn long, txn string, kind string, key string, after long")
    assert rows(changelog.committed_changes(df)) == [("c", 21, 4), ("d", 22, 6)]


@pytest.mark.parametrize("n", [1, 2, 5, 10])
def test_counter(spark, n):
    df = spark.createDataFrame([(0, i) for i in range(n)], "key long, o long")
    assert changelog.running_value(df, "key", "o").agg(F.max("value")).first()[0] == n


# --- learner --------------------------------------------------------------

def plain_ftrl(grads, w=0.0, s=learn.Ftrl()):
    z = n = 0.0
    for g in grads:
        z, n, w = map(float, s.step(*map(np.array, (z, n, w, g))))
    return z, n, w


def test_learner_fixture(spark):
    z, n, w = plain_ftrl([1, 1, -0.5])
    assert (z, n, w) == pytest.approx((2.252698, 10.936809, -0.052069), abs=1e-6)
    steps = spark.createDataFrame([(0, 0, r, g) for r, g in enumerate([1.0, 1.0, -0.5])],
                                  "key int, idx int, round long, val double")
    init = spark.createDataFrame([(0, 0, 0.0)], "key int, idx int, w double")
    got = learn.ftrl_fold(steps, init, "round").first()
    assert (got.z, got.n, got.w) == pytest.approx((z, n, w))


@pytest.mark.parametrize("variant", ["reference", "published"])
@pytest.mark.parametrize("bits", [0, 6])
def test_fold_in_blocks(spark, variant, bits):
    rnd = random.Random(7)
    s = learn.Ftrl(variant=variant)
    data = [(k, i, r, rnd.uniform(-0.2, 0.2)) for k in (0, 1) for i in (0, 1) for r in range(9)]
    steps = spark.createDataFrame(data, "key int, idx int, round long, val double")
    init = spark.createDataFrame([(k, i, 0.1 * i) for k in (0, 1) for i in (0, 1)] + [(2, 0, 0.5)],
                                 "key int, idx int, w double")
    got = {(r.key, r.idx): (r.z, r.n, r.w) for r in learn.ftrl_fold(steps, init, "round", s, bits).collect()}
    assert got[(2, 0)] == (0.0, 0.0, 0.5)
    for k in (0, 1):
        for i in (0, 1):
            want = plain_ftrl([g for kk, ii, _, g in data if (kk, ii) == (k, i)], 0.1 * i, s)
            assert got[(k, i)] == pytest.approx(want)


def test_fold_takes_one_job_whatever_the_order(spark):
    init = spark.createDataFrame([(0, 0, 0.0)], "key int, idx int, w double")
    steps = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 10 ** 12, 0.5), (0, 0, 10 ** 12, -0.25)],
                                  "key int, idx int, round long, val double")
    spark.sparkContext.setJobGroup("fold", "fold")
    got = learn.ftrl_fold(steps, init, "round").first()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fold"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 4
    assert any((got.z, got.n, got.w) == pytest.approx(plain_ftrl([1.0, *g])) for g in ((0.5, -0.25), (-0.25, 0.5)))


def test_pushes_without_a_start_fail(spark):
    steps = spark.createDataFrame([(0, 0, 0, 1.0), (1, 0, 0, 1.0), (0, 5, 0, 1.0)], "key int, idx int, round long, val double")
    init = spark.createDataFrame([(0, 0, 0.0)], "key int, idx int, w double")
    for rows_ in (steps, steps.where("idx = 5"), steps.where("key = 1")):
        with pytest.raises(Exception, match="no starting weight"):
            learn.ftrl_fold(rows_, init, "round").collect()
    pushes = spark.createDataFrame([(1, 0, [1.0])], "key int, seq long, vec array<double>")
    with pytest.raises(Exception, match="no starting weight"):
        learn.async_sums(pushes, init).collect()


def test_rounds_wait_for_all_workers(spark):
    df = spark.createDataFrame([(0, 0, [1.0, 2.0]), (0, 0, [3.0, 4.0]), (0, 1, [9.0, 9.0])],
                               "key int, round long, vec array<double>")
    assert rows(learn.gradient_rounds(df, 2)) == [(0, 0, 0, 2.0), (0, 0, 1, 3.0)]
    init = spark.createDataFrame([(0, 0, 0.0), (0, 1, 0.5)], "key int, idx int, w double")
    assert rows(learn.round_sums(df, init, 2)) == [(0, 0, 0, 4.0), (0, 0, 1, 6.5)]
    assert rows(learn.sgd_sync(df, init, 2, 0.1)) == [
        (0, 0, 0, pytest.approx(-0.4)), (0, 0, 1, pytest.approx(-0.1))]


def test_vector_rounds_fixture(spark):
    workers = 2
    df = spark.createDataFrame([(0, 0, w, [1.0] * 100) for w in range(workers)],
                               "key int, round long, worker int, vec array<double>")
    init = spark.createDataFrame([(0, i, 0.0) for i in range(100)], "key int, idx int, w double")
    got = learn.round_sums(df, init, workers)
    assert got.where("w <> 2").count() == 0 and got.count() == 100


def plain_train(x, y, workers, epochs, s=learn.Ftrl()):
    d = x.shape[1]
    state = [(0.0, 0.0, 0.0)] * d
    for _ in range(epochs):
        w = np.array([t[2] for t in state])
        g = ((1 / (1 + np.exp(-x @ w)) - y) @ x) / workers
        state = [tuple(map(float, s.step(*map(np.array, (*state[i], g[i]))))) for i in range(d)]
    return state


@pytest.mark.parametrize("seen", [4, 2])
def test_training(spark, seen):
    """The mean is over the workers there are, also when fewer have rows."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4))
    y = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(60)],
                               "id long, f array<double>, y int").repartition(3)
    got = learn.train(df, "f", "y", F.col("id") % seen, 4, 4, epochs=3)
    for r in got.collect():
        assert (r.z, r.n, r.w) == pytest.approx(plain_train(x, y, 4, 3)[r.idx])
    w = [r.w for r in got.orderBy("idx").collect()]
    right = learn.predict(df, "f", w).where("predicted = y").count()
    assert right > 40
    table = learn.predict_table(df, "id", "f", got.select("idx", "w"))
    assert table.where("predicted = y").count() == right


def test_training_of_a_wide_model(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(12, 700)), np.arange(12) % 2
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(12)], "id long, f array<double>, y int")
    got = {r.idx: (r.z, r.n, r.w) for r in learn.train(df, "f", "y", F.lit(0), 1, 700, epochs=2).collect()}
    want = plain_train(x, y, 1, 2)
    assert all(got[i] == pytest.approx(want[i]) for i in range(700))
    with pytest.raises(Exception):
        learn.train(df, "f", "y", F.lit(0), 1, 699, epochs=1)


# --- profiles -------------------------------------------------------------

def test_histogram_edges_and_selectivity(spark):
    df = spark.createDataFrame([(v,) for v in range(1, 11)], "v int")
    hist = profile.histogram(df, "v", 5, 1, 10)
    assert rows(hist) == [(i, 2) for i in range(5)]
    for op, share in {"=": 0.1, "<>": 0.9, "<": 0.2, "<=": 0.3, ">": 0.7, ">=": 0.8, "LIKE": 0.1}.items():
        assert profile.selectivity(hist, op, 3, 5, 1, 10).first()[0] == pytest.approx(share)
    assert profile.selectivity(hist, "<", 100, 5, 1, 10).first()[0] == 1.0
    assert profile.selectivity(hist, "=", 100, 5, 1, 10).first()[0] == 0.0
    assert profile.selectivity(hist.where("false"), "=", 1, 5, 1, 10).first()[0] == 0.0


def test_values_outside_are_an_error_and_wide_ranges_hold(spark):
    df = spark.createDataFrame([(5,), (500,), (None,)], "v long")
    with pytest.raises(Exception, match="not within 1 and 50"):
        profile.histogram(df, "v", 5, 1, 50).collect()
    low, high = profile.bounds_of(df, "v")
    assert profile.selectivity(profile.histogram(df, "v", 5, low, high), ">", 250, 5, low, high).first()[0] == pytest.approx(0.5)
    wide = spark.createDataFrame([(0,), (2 ** 60,), (-2 ** 62,)], "v long")
    hist = profile.histogram(wide, "v", 100, *profile.bounds_of(wide, "v"))
    assert rows(hist) == [(0, 1), (79, 1), (99, 1)]
    assert profile.selectivity(hist, "<", -1, 100, *profile.bounds_of(wide, "v")).first()[0] == pytest.approx(2 / 3, abs=0.34)
    assert profile.table_stats(wide, 100).count() == 3
    assert profile.bounds_of(df.where("false"), "v") == (0, 0)


def test_string_selectivity(spark):
    df = spark.createDataFrame([("apple",), ("banana",), ("cherry",), ("zzzz",)], "s string")
    got = profile.string_selectivity(df, "s", "<", "c", 1000).first()[0]
    assert got == pytest.approx(0.5, abs=0.01)


def test_table_stats(spark):
    df = spark.createDataFrame([(i, i % 3, "x", None) for i in range(50)], "a int, b long, s string, e int")
    stats = profile.table_stats(df, 10)
    assert stats.groupBy("column").agg(F.sum("count")).orderBy("column").collect() == [("a", 50), ("b", 50), ("s", 50)]
    assert tuple(profile.stats_cardinality(stats, "a", "<", 25, 10).first()) == (50, pytest.approx(0.5), 25)
    assert profile.stats_cardinality(stats, "s", ">", "a", 10).first()["cardinality"] == 50
    assert tuple(profile.stats_cardinality(stats, "e", "=", 1, 10).first()) == (0, 0.0, 0)
    assert math.isclose(stats.where("column = 'a' AND bucket = 9").first()["count"], 5)
