import pytest
from pyspark.sql import functions as F

#: Extra columns whose names the operators use inside.
CLASHES = ["id", "hash", "key", "node", "root", "digest", "words", "n", "c0", "n_words", "n_tokens", "kept", "flags", "shard", "file",
           "block", "row", "train", "i", "h", "at", "label_", "vector", "print", "found"]

BASE = ("the quick brown fox jumps over the lazy dog near the river bank while seven grey geese watch from the far side and a "
        "small boy counts them twice before he walks home through the wet grass with his shoes in one hand and a stick in the "
        "other because the path is too muddy after the long rain of last week")
ITEM = "Which of these seven rivers carries the most water to the sea in a dry year?"


def _texts() -> list:
    other = " ".join(f"w{i}" for i in range(160))
    near = BASE.replace("small boy", "tall girl")
    return [
        BASE, BASE, BASE.upper(), near, near + " again", other, other + " " + BASE, BASE + " " + other, None, "", "   \n\t ", "one",
        "one two", "ONE TWO", "one two three", "12 34 -- !!", "é", "Überall liegt Schnee und der Wind weht kalt",
        "word " * 3000, "x" * 5000, other[:300] + " " + ITEM + " " + other[300:], ITEM.lower(), "prefix " + ITEM, "yes", "a yes man",
        "first line\nsecond line\nfirst line\n\n  FIRST   line ", "second line\nthird line", "\n\n", "tail\n" + BASE, BASE + "\n" + BASE,
        "line one is here and has a good many words so that one change is small in it\nx", "<|endoftext|> don't <s> 漢字 😀",
        "line one is here and has a good many words so that one change is little in it\ny", BASE, "one two", other,
    ]


@pytest.fixture(scope="session")
def hand_rows():
    """(doc_id, text) of hand-made cases; ids come out of order."""
    texts = _texts()
    return [((k * 7) % len(texts) + 100, text) for k, text in enumerate(texts)]


def documents(spark, rows, extra: bool = True):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    langs = F.array(F.lit("en"), F.lit("de"), F.lit(None).cast("string"))
    df = df.withColumn("lang", langs[(F.coalesce("doc_id", F.lit(0)) % 3).cast("int")]).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHES)) if extra else df


@pytest.fixture(scope="session")
def hand_docs(spark, hand_rows):
    return documents(spark, hand_rows).cache()


@pytest.fixture(scope="session")
def empty_docs(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def small(spark, sf):
    """(doc_id, text) of the smallest documents table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def small_docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: documents(spark, rows)
