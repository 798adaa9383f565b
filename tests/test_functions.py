"""Scalar expressions against their fixtures."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import arrays, hashing, text
from millrace.functions.times import epoch_ms


def one(spark, value, fn, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(fn(F.col("v")).alias("o")).first()[0]


@pytest.mark.parametrize("line, words", [
    ("a  b ", ["a", "", "b"]), ("", [""]), ("   ", []), (" a", ["", "a"]), ("a", ["a"]),
])
def test_split_java(spark, line, words):
    assert one(spark, line, text.split_java) == words


def test_split_fields(spark):
    assert one(spark, " a\tb c\n\nd ", text.split_fields) == ["a", "b", "c", "d"]
    assert one(spark, "", text.split_fields) == []


def test_split_letters(spark):
    assert one(spark, "It's été, 2nd!", text.split_letters) == ["It", "s", "été", "nd"]


@pytest.mark.parametrize("value, number", [
    ("6", 6), ("", 0), ("abc", 0), ("-1.5e2x", -150), (" +7", 7), (".5", 0.5), ("5.", 5), ("6e", 6),
    ("-", 0), ("1e2", 100), ("aefgwef", 0), ("2.5e-1", 0.25), ("1e0000000000002", 100), ("12abc", 12),
])
def test_lenient_float(spark, value, number):
    assert one(spark, value, text.lenient_float) == pytest.approx(number)


def test_lenient_float_clamps_the_exponent(spark):
    assert one(spark, "1e50", text.lenient_float) == pytest.approx(1e38, rel=1e-6)
    assert one(spark, "1e99999999999", text.lenient_float) == pytest.approx(1e38, rel=1e-6)


@pytest.mark.parametrize("word, value", [
    ("the", 873378332), ("é", 513665217), ("0", 890022063), ("", 18652613),
])
def test_positive_hash(spark, word, value):
    assert one(spark, word, hashing.positive_hash) == value


@pytest.mark.parametrize("key, shard", [("", 0), ("a", 97 % 10), ("é", 0xC3 % 10), ("0", 48 % 10)])
def test_shard_bucket(spark, key, shard):
    assert one(spark, key, hashing.shard_bucket) == shard


def test_prefix_code(spark):
    code = lambda s: one(spark, s, hashing.str_prefix_code)
    assert code("") == 0
    assert code("zzzz") == hashing.PREFIX_MAX == code("zzzzz")
    assert code("ab") == (97 << 24) + (98 << 16)
    assert code("é") == 0
    assert code("~") == hashing.PREFIX_MAX


def test_ordered_code_keeps_order(spark):
    words = ["", "a", "ab", "abcdefgh", "abcdefgi", "b", "zz", "é"]
    df = spark.createDataFrame([(w,) for w in words], "v string")
    codes = [r[0] for r in df.select(hashing.ordered_code(F.col("v"))).collect()]
    assert codes == sorted(codes)


def test_trim_truncate(spark):
    assert one(spark, "\t x \r", text.trim_truncate) == "x"
    assert len(one(spark, "y" * 200, text.trim_truncate)) == 128


def test_dot_product_checks_sizes(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0])], "a array<double>, b array<double>")
    assert df.select(arrays.dot_product(F.col("a"), F.col("b"))).first()[0] == 11.0
    bad = spark.createDataFrame([([1.0], [3.0, 4.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception, match="vector sizes differ"):
        bad.select(arrays.dot_product(F.col("a"), F.col("b"))).collect()


def test_array_access(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
    assert df.select(arrays.array_slice(F.col("v"), 1, 3)).first()[0] == [2.0, 3.0]
    assert df.select(arrays.array_at(F.col("v"), 2)).first()[0] == 3.0
    with pytest.raises(Exception, match="out of range"):
        df.select(arrays.array_at(F.col("v"), 3)).collect()


@pytest.mark.parametrize("op, out", [
    ("ASSIGN", 3), ("PLUS", 9), ("MINUS", 3), ("TIMES", 18), ("DIVIDE", 2), ("AND", 2), ("OR", 7), ("XOR", 5),
])
def test_assign(spark, op, out):
    df = spark.createDataFrame([(6, 3)], "a int, b int")
    assert df.select(arrays.assign(op, F.col("a"), F.col("b"))).first()[0] == out


def test_integers_divide_with_truncation(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (3, 0)], "a int, b int")
    pick = lambda where: [r[0] for r in df.where(where).select(
        arrays.assign("DIVIDE", F.col("a"), F.col("b"), True)).collect()]
    assert pick("b = 2") == [3, -3]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|zero"):
        pick("b = 0")


def test_epoch_ms_ignores_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07.179575' AS t")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(epoch_ms(F.col("t"))).first()[0] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
