import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import learn
from tests.test_jobs import plain_ftrl


def test_fold_of_one_key_spreads_over_tasks(spark):
    """One key of 64 positions: its chains are folded in more than one task, with the results of one chain each."""
    rnd = random.Random(3)
    data = [(0, i, o, rnd.uniform(-0.2, 0.2)) for i in range(64) for o in range(5)]
    steps = spark.createDataFrame(data, "key int, idx int, seq long, val double")
    init = spark.createDataFrame([(0, i, 0.01 * i) for i in range(64)], "key int, idx int, w double")
    folded = learn.ftrl_fold(steps, init, "seq").withColumn("part", F.spark_partition_id())
    got = {r.idx: r for r in folded.collect()}
    assert len({r.part for r in got.values()}) > 1
    for i in range(64):
        want = plain_ftrl([g for _, ii, _, g in sorted(data, key=lambda d: d[2]) if ii == i], 0.01 * i)
        assert (got[i].z, got[i].n, got[i].w) == pytest.approx(want)
