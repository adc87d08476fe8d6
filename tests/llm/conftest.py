import pytest

from salesmart.llm.common import documents

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_rows():
    """Nulls, empty and long texts, ties, repeats, white space and symbols of all kinds."""
    long_text = " ".join(f"word{i % 977} a{i % 13}b" for i in range(60_000))
    rows = [
        (1, "alpha beta gamma delta epsilon", "en", "s1", 30),
        (2, "alpha  beta\tgamma\ndelta epsilon", "en", "s1", 31),
        (3, "alphabetagammadeltaepsilon", None, "s2", None),
        (4, "alpha beta gamma delta epsilon", "en", None, 30),
        (4, "alpha beta gamma delta epsilon", "en", None, 30),
        (5, None, None, None, None),
        (6, "", "en", "s3", 0),
        (7, " \t\n\x0b\x0c\r", "en", "s3", 6),
        (None, "no id here at all", "en", "s1", 17),
        (None, None, None, None, None),
        (8, "one", "fr", "s2", 3),
        (9, "ONE", "fr", "s2", 3),
        (10, "one two", "fr", "s2", 7),
        (11, long_text, "de", "s4", len(long_text)),
        (12, long_text + " tail", "de", "s4", len(long_text) + 5),
        (13, "x" * 120_000, "de", "s4", 120_000),
        (14, "1 " * 60_000, "de", "s4", 120_000),
        (15, "字 \x1c\x85  é🙂 'tis we'll don't   end  ", "zh", "s5", 30),
        (16, "mail a.b@c.example.org, b@c.de_d@e.f or +49 (170) 555-1234 and 10.0.0.255 256.1.1.1 4111 1111 1111 1111.", "en", "s5", 90),
        (17, "line\nline\n\nline\n \n#$%&|<>* line", "en", "s6", 30),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge):
    """The edge rows with extra columns named like the operators' own."""
    out = edge
    for name in ("row", "size", "draw", "copies", "sha", "_sha", "n", "rank", "target", "set_key", "bands", "rep", "component_id", "kept", "score", "base",
                 "region", "value", "path", "key", "ids", "n_tokens", "own_id", "word", "_salt", "limit", "block"):
        out = out.withColumn(name, out["n_chars"])
    return out


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return documents(spark, SMALL)


def by_id(frame):
    """Rows by doc_id, those without an id left out."""
    return {r["doc_id"]: r for r in frame.collect() if r["doc_id"] is not None}
