import os

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        *[T.StructField(name, T.StringType()) for name in ("key", "size", "piece", "length", "print", "component", "rate")],
    ]
)
TABLES = {
    "documents": DOCUMENTS,
    "embeddings": "vec_id long, embedding array<float>, label int, node long, copies string",
    "pages": "page_id long, url string, html string, key string, text string",
    "conversations": "conv_id long, turn long, role string, text string, conv string, times string",
    "labels": "doc_id long, quality int, toxic int, text string",
}


def document(doc_id, text, source="s0"):
    return (doc_id, text, "en", source, None if text is None else len(text), *["x"] * 7)


@pytest.fixture(scope="session")
def odd_documents():
    prose = " ".join(f"word{i} of the number{i % 17}" for i in range(200))
    rows = [
        document(0, None),
        document(1, ""),
        document(2, " \n\t "),
        document(3, "a b c"),
        document(4, "x" * 300_000),
        document(5, prose * 40),
        document(6, prose),
        document(6, prose),
        document(7, prose, None),
        document(None, prose + " more", "ü"),
        document(None, None, None),
        document(8, f'{prose} token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'),
        document(9, f"{prose}\nReleased under the MIT License."),
        document(10, "<|endoftext|> a<|endoftext|>b é\U0001f600 " + prose, "s1"),
        document(11, "same line\n" * 60, "s1"),
        document(12, "퟿￿\x00 nul and friends " + prose, "s2"),
    ]
    return rows + [document(100 + i, f"{prose} tail {i}", "hot") for i in range(20)]


@pytest.fixture(scope="session")
def folders(spark, tmp_path_factory, odd_documents):
    """Data folders with odd rows and with empty tables."""
    nan, inf = float("nan"), float("inf")
    vector = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    near = [1.01, *vector[1:]]
    embeddings = [
        (0, None), (1, []), (2, [0.0] * 8), (3, [None, *vector[1:]]), (4, [nan, *vector[1:]]), (5, [inf, *vector[1:]]),
        (6, vector), (6, vector), (7, near), (8, [-x for x in vector]), (9, [1.0, 2.0]), (10, [2.0, 4.0]), (None, near),
        (11, [1e30 * x for x in vector]),
    ]
    pages = [
        (0, None, None), (1, "", ""), (2, "http://[", "<p>a"), (3, "http://h.example/", "<article><p>x &amp; y</article>"),
        (3, "http://h.example/", "<article><p>x &amp; y</article>"), (None, "http://h.example/", "<"),
    ]
    conversations = [
        (0, None, None, None), (1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (2, 3, "", ""),
        (None, None, "system", " \n"), (None, 2, "tool", "x" * 300_000), (3, 2**40, "user", "\x00 é\U0001f600?"), (3, 7, "bot", "a\nb"),
    ]
    odd = {
        "conversations": [(*row, "x", "y") for row in conversations],
        "documents": odd_documents,
        "embeddings": [(i, v, 0, 1, "x") for i, v in embeddings],
        "pages": [(*row, "x", "y") for row in pages],
        "labels": [(3, 0, 0, "x"), (6, 1, 0, "x"), (6, 0, 1, "x"), (None, 1, 1, "x"), (7, None, None, "x"), (999, 1, 1, "x")],
    }
    made = {}
    for name, rows in (("odd", odd), ("empty", {t: [] for t in TABLES})):
        made[name] = str(tmp_path_factory.mktemp(name))
        for table, schema in TABLES.items():
            spark.createDataFrame(rows[table], schema).write.parquet(os.path.join(made[name], f"{table}.parquet"))
    return made
