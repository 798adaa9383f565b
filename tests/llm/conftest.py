import pytest

from millrace.llm import queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_2 string, id long, row long"

# Null, empty, blank, short and odd texts, ties, repeated rows.
TEXTS = [None, "", "   \n\t ", "a", "The THE the", "it's we'll 'S x''s 12345 a1b2", "naïve ÉCOLE straße ǅ İstanbul",
         "é ́ àb ﬁ Ω Σας ΣΑΣ", "<|endoftext|> x<|startoftext|>y <|endoftext|><|endoftext|>",
         "tab\tin\x0bside\x0cform\rfeed\x1c\x1d\x85nel em\xa0nbsp", "  lead  and trail  ", "a  b\n\n c \n d",
         "日本語のテキスト 한국어 ไทย 😀👍🏽 \U0001f9d1‍\U0001f680", "!!!???...,,,;;; -- __init__ a_b €100 ½ ²",
         "x" * 9000, "word " * 9000, "The THE the", "The THE the", "null", "<|im not special|>", "don't DON'T don'T"]


def internal_names(df):
    """Further columns with names that operators use inside."""
    names = "__row __slot __rank __tie __key __node __cuts tie range bucket part bits ones fingerprint component".split()
    return df.selectExpr("*", *[f"{7 + i}L AS {n}" for i, n in enumerate(names)])


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls in every column, ties, a repeated row and clashing extra columns."""
    rows = [(i, t, None if i % 3 else "en", None, None, "x", 1, 2) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, "only text", None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return internal_names(spark.createDataFrame(rows, SCHEMA)).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return internal_names(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="session")
def vocabulary():
    return queries.vocabulary
