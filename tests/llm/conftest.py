import pytest

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
#: (doc_id, text, lang, source): nulls, empty and blank texts, ties, copies, repeats, long ones, control characters
EDGES = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n\x0b\x0c\r ", "en", None),
    (4, "one two three", None, "a"),
    (5, "ONE two Three", "en", "a"),
    (6, "one two three four five six seven eight nine ten", "en", "b"),
    (7, "one two three four five six seven eight nine ten", "en", "b"),
    (8, "One two three four five six seven eight nine TEN", "en", "b"),
    (8, "One two three four five six seven eight nine TEN", "en", "b"),
    (None, "one two three four five six seven eight nine ten eleven twelve", "en", "b"),
    (10, LONG, "en", "b"),
    (11, LONG + " tail", "de", "b"),
    (12, "Élan ÉLAN élan x \U0001f600 \x00 á ẞ", "fr", "c"),
    (13, "a b c d e f g h a b c d e f g h a b c d e f g h", "fr", "c"),
    (14, "[INST] <|turn|> </s> %3C # * $ | < >", "fr", "c"),
    (15, "12345 !!! 67", "en", "c"),
]
#: Columns whose names operators might use inside.
CLASH = ["digest", "tokens", "n", "rep", "token", "kept", "row", "line", "bucket", "block", "at", "label", "weight", "_t", "_w", "c0", "topic", "page_id", "html_", "place", "held_out"]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge cases with unused columns of every clashing name."""
    from pyspark.sql import functions as F

    d = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    return d.withColumns({c: F.lit(7) for c in CLASH if c not in d.columns})


@pytest.fixture(scope="session")
def none(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def cases(edges, documents):
    """Edge cases without rows that repeat, and the documents of the smallest table."""
    return edges.select(documents.columns[:4]).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).selectExpr("doc_id - 100 AS doc_id", "text", "lang", "source").unionByName(documents.drop("n_chars"))
