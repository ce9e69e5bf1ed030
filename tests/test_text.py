from pyspark.sql import functions as F

from threadloom.functions.text import clean_text, length_code, normalize_ws, strip_ws, token_count


def test_whitespace_map(spark):
    df = spark.createDataFrame([("a b\nc\td\re",)], "t string")
    assert df.select(normalize_ws("t")).first()[0] == "a b c de"


def test_strip_unicode(spark):
    s = "　\x1c x y  \x85"
    df = spark.createDataFrame([(s,)], "t string")
    assert df.select(strip_ws("t")).first()[0] == s.strip()
    assert df.select(clean_text("t")).first()[0] == "x y"


def test_length_codes(spark):
    df = spark.createDataFrame([(n,) for n in (15, 16, 50, 51, 256, 257)], "n int")
    got = [r[0] for r in df.select(length_code("n")).collect()]
    assert got == ["1", "2", "2", "3", "3", "-"]


def test_token_count(spark):
    df = spark.createDataFrame([("Hello world, it's 42!",), ("a\n\nb",), ("",)], "t string")
    got = [r[0] for r in df.select(token_count("t")).collect()]
    # Hello | " world" | "," | " it" | "'s" | " 42" | "!"  ;  a | " " | " b"
    assert got == [7, 3, 0]
