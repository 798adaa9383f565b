"""Line dedup beside a plain version, and the levels of its runs."""

import collections

import pytest

from millrace.llm import line_dedup
from millrace.llm.common import LOWER, UPPER

LINE = "the quick brown fox jumps over"


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(str.maketrans(UPPER, LOWER))


def brute(rows, least_chars=20, least_docs=3):
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    rank = lambda i: (i is not None, i or 0)
    owner = {k: max(ids, key=rank) for k, ids in holders.items() if len(ids) >= least_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if owner.get(key(line), i) == i]
        out.append((repr(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def result(found):
    return sorted((repr(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept"]) for r in found.collect())


def texts():
    """Lines in one, two, three and many documents, with blanks, cases and repeats."""
    rows = []
    for i in range(40):
        lines = [f"document {i} has a line of its own", "  \t" + LINE.upper() + "\r" if i % 2 else LINE, "short"]
        if i % 10 == 3:
            lines += ["a line that stands in four texts", "a line that stands in four texts", ""]
        if i in (7, 8):
            lines.append("a line that stands in two texts")
        lines += [f"shared by the group number {i // 3} only", "É" + "x" * 18, "é" + "x" * 19, ""]
        rows.append((i, "\n".join(lines)))
    rows += [(None, LINE + "\nother text"), (None, LINE), (None, None), (5, LINE + "\n" + LINE), (5, LINE + "\n" + LINE), (41, ""),
             (42, "\n\n"), (43, ("word " * 40 + "\n") * 3000), (44, "word " * 40), (45, "y" * 3_000_000 + "\n" + "word " * 40)]
    return rows


@pytest.mark.parametrize("batches, fan", [(1, 2), (4, 2), (6, 3)])
def test_like_brute_force(spark, batches, fan):
    docs = spark.createDataFrame(texts(), "doc_id long, text string").repartition(3)
    assert result(line_dedup.remove_lines(docs, batches=batches, fan=fan)) == brute(texts())


def test_odd_and_empty_tables(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert result(line_dedup.remove_lines(odd, least_chars=1, least_docs=2)) == brute(rows, 1, 2)
    assert line_dedup.remove_lines(empty).collect() == []
    clash = odd.selectExpr("*", "1 AS k1", "2 AS k2", "3 AS t1", "4 AS gone", "5 AS lines", "6 AS batch", "7 AS pos", "8 AS owner", "9 AS __doc", "10 AS __extra0")
    out = line_dedup.drop_lines(clash, least_chars=1, least_docs=2)
    assert out.columns == clash.columns
    want = brute(rows, 1, 2)
    assert sorted((repr(r["doc_id"]), r["text"]) for r in out.collect()) == [(w[0], w[3]) for w in sorted(want, key=lambda w: (w[0], w[3]))]


def test_a_settled_key_adds_nothing(spark):
    """A key known often enough with a larger owner isn't added again; one with a smaller owner is."""
    runs = line_dedup.LineRuns(spark, fan=9, least_docs=3)
    batch = lambda ids: spark.createDataFrame([(i, 1, 1) for i in ids], "id long, k1 long, k2 long")
    for ids in ([10, 11, 12], [7, 8, 9], [13], [14, 15, 16]):
        runs.add(batch(ids))
    assert [run.count() for run in runs.runs()] == [1, 0, 1, 1]
    assert [tuple(r) for r in runs.repeated().collect()] == [(1, 1, 16)]


def test_full_levels_are_merged(spark):
    runs = line_dedup.LineRuns(spark, fan=2, least_docs=3)
    for n in range(7):
        runs.add(spark.range(n * 10, n * 10 + 10).selectExpr("id", "id % 3 AS k1", "id % 2 AS k2"))
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    got = {(r["k1"], r["k2"]): r["owner"] for r in runs.repeated().collect()}
    assert got == {(i % 3, i % 2): i for i in range(64, 70)}


def test_runs_meet_without_an_exchange(spark):
    runs = line_dedup.LineRuns(spark)
    runs.add(spark.range(100).selectExpr("id", "id % 3 AS k1", "id % 2 AS k2"))
    _, run = runs.levels[0][0]
    plan = run.hint("merge").join(run.selectExpr("k1", "k2", "docs AS d"), ["k1", "k2"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
