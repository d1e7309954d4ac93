from pyspark.sql import functions as F

from lamella.functions import text as X


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "text string").select(column.alias("x")).first().x


def test_normal_form(spark):
    assert one(spark, "a\x00b  c\n 12 \n\n\n\nd\t e \n12345\n", X.normalize("text")) == "ab c\n\nd e \n12345"
    assert one(spark, None, X.normalize("text")) is None
    assert one(spark, "", X.normalize("text")) == ""


def test_chunks_drop_short_tails(spark):
    text = " ".join(f"word{i}" for i in range(200))
    got = one(spark, text, X.chunks("text"))
    assert len(got) == 2 and got[0].split() == text.split()[:180] and got[1].split() == text.split()[180:]
    assert one(spark, "short", X.chunks("text")) == []
    assert one(spark, "", X.chunks("text")) == []


def test_shingles_of_few_words(spark):
    assert one(spark, "a b c", X.shingles(X.words("text"))) == ["a b c"]
    assert one(spark, "a b c d e f", X.shingles(X.words("text"))) == ["a b c d e", "b c d e f"]


def test_years(spark):
    year = lambda n, t: spark.createDataFrame([(n, t)], "n string, t string").select(X.document_year("n", "t").alias("y")).first().y
    assert year("policy_2024_25", "2012") == 2025
    assert year("policy_2023_28", "") == 2023
    assert year("policy", "in 2019 and 2031, not 12019") == 2031
    assert year("policy", "none") == 0


def test_sentences(spark):
    assert one(spark, "One. Two: three; (four) e.g. five", X.sentences("text")) == ["One.", "Two: three;", "(four) e.g. five"]


def test_masked(spark):
    mask = lambda k, v: spark.createDataFrame([(k, v)], "k string, v string").select(X.masked("k", "v").alias("m")).first().m
    assert mask("EMAIL", "abcdef.gh@site.org") == "ab****.**@site.org"
    assert mask("PAN", "AB") == "**"
    assert mask("PHONE", "98765-43210") == "98***-*****"


def test_band(spark):
    got = spark.createDataFrame([(0.7,), (0.4,), (0.1,)], "s double").select(X.band("s").alias("b")).collect()
    assert [r.b.split()[0] for r in got] == ["High", "Moderate", "Low"]


def test_signature(spark):
    assert one(spark, "  Page  12 of 300 ", X.signature("text")) == "page # of #"
    assert one(spark, "x", F.col("text")) == "x"
