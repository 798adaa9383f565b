"""The driver contract, and functions that travel with their query."""

import os
import subprocess
import sys

from pyspark import cloudpickle

import __spark_entry__ as entry
from millrace import plans
from millrace.plans import texts
from millrace.streaming import jobs


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)
    assert set(plans.QUERIES) <= set(entry.queries())
    assert len(plans.QUERIES) == 143


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "n_docs", "segment", "docs"]
    assert df.count() > 0


def test_workers_need_no_copy_of_the_package(tmp_path):
    blob = tmp_path / "fn.pkl"
    blob.write_bytes(cloudpickle.dumps((texts.map_words, texts.WordPairs.func, jobs._partials,
                                        jobs._add_to_session)))
    code = "import pickle; f = pickle.load(open('fn.pkl', 'rb')); print(f[0]('n', 'a b'))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=120)
    assert out.stdout.strip() == "[('a', '1'), ('b', '1')]", out.stderr


def test_a_module_that_is_missing_leaves_those_queries_out(tmp_path):
    """Neither the folder nor what it imports is needed for the other queries."""
    code = ("import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); "
            "print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))")
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(plans.QUERIES)), "False"], out.stderr
