"""Cleaner golden rows and tokenizer behaviour."""
import hashlib

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions.scalar import md5_bucket, round_half_away

# Golden rows of the original preprocessing pipeline (input → processed).
GOLDEN = [
    ("I am loving the new AI tools! They are running amazingly well.", "love new ai tool run amazingly well"),
    ("Python makes machine learning easier.", "python make machine learn easier"),
    ("Natural Language Processing is interesting.", "natural language process interest"),
]


def test_preprocess_pipeline_golden(spark):
    df = spark.createDataFrame(GOLDEN, "text string, expected string")
    toks = X.lemmatize(X.remove_stop(X.tokenize_alpha(X.clean_text("text", "pipeline"))), "v")
    rows = df.select(F.array_join(toks, " ").alias("got"), "expected").collect()
    assert [r.got for r in rows] == [r.expected for r in rows]


def test_pipeline_cleaner_handles_null_and_digits(spark):
    df = spark.createDataFrame([(None,), ("Call 555-1234 NOW!!",)], "text string")
    got = [r[0] for r in df.select(X.clean_text("text", "pipeline")).collect()]
    assert got == ["", "call now"]


def test_chat_cleaner_punctuation_to_space(spark):
    df = spark.createDataFrame([("what's the weather,in Paris?",)], "text string")
    got = df.select(F.array_join(X.clean_tokens("text", "chat"), " ")).first()[0]
    assert got == "what s the weather in paris"


def test_summary_cleaner_glues_lines(spark):
    df = spark.createDataFrame([("See http://x.y/z <b>bold</b> line\nnext!",)], "text string")
    assert df.select(X.clean_text("text", "summary")).first()[0] == "see bold linenext!"


def test_sentence_split(spark):
    df = spark.createDataFrame([("One. Two!  Three? four",)], "text string")
    got = df.select(X.sentence_split(X.clean_text("text", "whitespace"))).first()[0]
    assert got == ["One.", "Two!", "Three?", "four"]


def test_md5_bucket_matches_python(spark):
    ids = list(range(0, 60)) + [123456789, 987654321012]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r.b for r in df.select("id", md5_bucket("id", 3).alias("b")).collect()}
    for i in ids:
        assert got[i] == int(hashlib.md5(str(i).encode()).hexdigest(), 16) % 3
    got7 = {r.id: r.b for r in df.select("id", md5_bucket("id", 7).alias("b")).collect()}
    for i in ids:
        assert got7[i] == int(hashlib.md5(str(i).encode()).hexdigest(), 16) % 7


def test_round_half_away_rounds_binary_value(spark):
    df = spark.createDataFrame([(2.425,), (0.14325,), (2.5,), (-1.005,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    assert got[0] == 2.42 and got[2] == 2.5
