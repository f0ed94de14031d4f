import pytest

#: Rows that every operator must take: nulls, empty and blank texts, ties, repeated rows, a long text.
EDGE_TEXTS = [
    (1, "one two three four five six seven eight nine ten"),
    (1, "one two three four five six seven eight nine ten"),  # a repeated row
    (2, "One TWO three four five six seven eight nine ten"),
    (3, None),
    (4, ""),
    (5, " \n\t \n"),
    (None, "one two three four five six seven eight nine ten"),
    (6, "a"),
    (7, "word " * 30_000),
    (8, "x" * 200_000),
    (9, "ünï cödé … 中文字符 🙂 end line"),
    (10, "line a\nline b\nline c\nline d"),
    (11, "other\nline a\nline b\nline c\nrest"),
    (12, "mail me at jane.doe@example.org or +49 (30) 1234-5678, host 10.0.0.1, card 4111 1111 1111 1111"),
]
CLASHES = "id, n, d, k, j, f, w1, key, part, length, start, rank, salt, bucket, vector, verdict, score, rows, row, runs, text2"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The rows above with columns whose names the operators use themselves."""
    docs = spark.createDataFrame(EDGE_TEXTS, "doc_id long, text string")
    return docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) as long) AS n_chars",
                           *[f"'clash' AS `{name}`" for name in CLASHES.split(", ")])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
