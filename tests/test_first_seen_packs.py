"""first_seen: keys of a bucket are kept in packs, one element of state per batch, and values come through as they were."""

import random

from millrace.streaming import processors, run


def _feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    fresh = processors.first_seen(stream, "request", 600_000)
    run.drain(fresh, "update", checkpoint=f"{folder}/c", out=f"{folder}/out", settings=processors.ROCKSDB)
    return run.all_batches(spark, f"{folder}/out", fresh.schema)


def test_state_grows_by_an_element_per_bucket_and_not_per_key(spark, tmp_path):
    rng = random.Random(5)
    batches = [[(f"r{rng.randrange(4000)}", n) for n in rng.sample(range(9000), 5000)] for _ in range(2)]
    want = {}
    for batch in batches:
        least = {}
        for k, n in batch:
            least[k] = min(n, least.get(k, n))
        want = least | want
    for batch in batches:
        found = _feed(spark, tmp_path, batch, "request string, value long")
    assert sorted((r["request"], r["value"]) for r in found.collect()) == sorted(want.items())
    held = spark.read.format("statestore").option("stateVarName", "seen").load(f"{tmp_path}/c").count()
    assert 0 < held <= 2 * processors.FIRST_SEEN_BUCKETS < len(want)


def test_types_nulls_and_a_column_of_lists(spark, tmp_path):
    big = 2**60 + 1
    schema = "request long, value long, name string, parts array<int>"
    first = [(None, 4, "n", [1]), (None, 3, "n", None), (1, big, "b", [2, 1]), (1, big, "b", [1, 9]), (2, 7, "", [])]
    _feed(spark, tmp_path, first, schema)
    found = _feed(spark, tmp_path, [(None, 1, "x", [1]), (1, 0, "x", [1]), (3, None, "c", None)], schema)
    got = {r["request"]: (r["value"], r["name"], r["parts"]) for r in found.collect()}
    assert got == {None: (3, "n", None), 1: (big, "b", [1, 9]), 2: (7, "", []), 3: (None, "c", None)}
    assert found.count() == 4
