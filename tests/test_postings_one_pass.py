"""postings.build reads the word cells once: one aggregation, no join of counts back to the cells."""

from millrace.operators import postings


def test_build_aggregates_the_cells_once_and_keeps_lists_and_bitmaps(spark):
    docs = spark.createDataFrame([(i, "a b" if i % 2 else "a") for i in range(100)], "doc_id long, text string")
    index = postings.build(docs, "doc_id", "text", few=60)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Union" not in plan
    got = {r["word"]: (r["n"], r["places"] is None, r["bitmap"] is None) for r in index.collect()}
    assert got == {"a": (100, True, False), "b": (50, False, True)}
