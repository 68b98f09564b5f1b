import pytest
from pyspark.sql import functions as F

from graniteflow.functions import text as tx
from graniteflow.operators.classify import Cleaner


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn("t").alias("r")).first()["r"]


@pytest.mark.parametrize("raw,clean", [
    ("https://a.b/c?d rest\nkeep", "keep"),
    ("see https://a.b/c", "see https://a.b/c"),
    ("a<br />b", "a b"),
    ("&quot;x&quot; it&#39;s", '"x" it"s'),
    ("are u sure", "are you sure"),
    ("`tick`   gap", "tick gap"),
    ("wow!!! what??", "wow! what?"),
    ("a &amp; b", "a and b"),
    ("a \r b", "a   b"),
    ("café ole", "caf ole"),
    ("x <b>bold</b> y", "x bold y"),
    ("a<\nb>c", "ac"),
    ("", ""),
])
def test_clean_text(spark, raw, clean):
    assert one(spark, raw, tx.clean_text) == clean


def test_cleaner_flag(spark):
    df = spark.createDataFrame([("a<br />b",)], "t string")
    on = Cleaner(inputCol="t", outputCol="o", enabled=True).transform(df).first()["o"]
    off = Cleaner(inputCol="t", outputCol="o", enabled=False).transform(df).first()["o"]
    assert (on, off) == ("a b", "a<br />b")


def test_tokens_cover_accents_and_drop_single_letters(spark):
    assert one(spark, "Éé abc x9 a ço", tx.tokens) == ["éé", "abc", "x9", "ço"]


def test_legal_words(spark):
    words = lambda c: tx.legal_words(tx.tokens(c))
    assert one(spark, "the river is 4you deep x9", words) == ["river", "deep"]
    assert one(spark, "the is", words) == []


def test_sentences(spark):
    df = spark.createDataFrame([(1, "One two. Three! Four")], "id int, t string")
    assert [r["sentence"] for r in tx.sentences(df, "t").orderBy("sentence_no").collect()] == ["One two", "Three", "Four"]


PAIRS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall",
    "filing": "file", "happy": "happi", "relational": "relat", "conditional": "condit", "digitizer": "digit",
    "vietnamization": "vietnam", "triplicate": "triplic", "hopefulness": "hope", "adjustment": "adjust",
    "adoption": "adopt", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "dying": "die", "is": "is", "died": "die", "spied": "spi",
}


def test_stem(spark):
    df = spark.createDataFrame([(w,) for w in PAIRS] + [(None,)], "w string")
    got = {r["w"]: r["s"] for r in df.select("w", tx.stem("w").alias("s")).collect()}
    assert got == {**PAIRS, None: None}


def test_strip_hashtags_and_split(spark):
    df = spark.createDataFrame([("#win big #win #go now", ["win", "go"]), ("", [])], "t string, h array<string>")
    got = [r["r"] for r in df.select(tx.split_words(tx.strip_hashtags("t", "h")).alias("r")).collect()]
    assert got == [["big", "now"], []]


def test_parse_list(spark):
    assert one(spark, "['a', \"it's\", 'x y']", tx.parse_list) == ["a", "it's", "x y"]
    assert one(spark, "[]", tx.parse_list) == []


def test_lemmatize_falls_back_to_the_form(spark):
    words = spark.createDataFrame([("Geese", "n"), ("runs", "v"), ("runs", "n"), ("blue", None)], "token string, pos string")
    table = spark.createDataFrame([("geese", "n", "goose"), ("runs", "v", "run")], "form string, pos string, lemma string")
    got = sorted(r["lemma"] for r in tx.lemmatize(words, table).collect())
    assert got == ["blue", "goose", "run", "runs"]


def test_distinct_values(spark):
    df = spark.createDataFrame([("a|b",), ("b|c",)], "g string")
    assert tx.distinct_values(df, "g").first()["n_values"] == 3
    assert df.select(F.lit(1)).count() == 2
