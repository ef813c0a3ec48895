"""Small tables for the llm tests: defined edge cases and seeded invented prose."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside.
CLASHES = ["key", "node", "length", "count", "spans", "digest", "component", "tokens", "rep", "first", "grade", "n", "a.b", "kept"]


def prose(n: int, seed: int, words: int = 400) -> str:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("aeioubcdfglmnprst") for _ in range(r.randint(2, 9))) for _ in range(words)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


def edge_rows():
    long = prose(60_000, 1)
    body = prose(180, 2)
    return [
        (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \n\t\r", None, "a", 4), (4, "one", "en", "a", 3),
        (5, "one", "en", "b", 3), (6, long, "en", "a", len(long)), (7, long, "de", "a", len(long)),
        (8, body, "de", "a", len(body)), (8, body, "de", "a", len(body)), (9, body + " tail", "fr", "a", 1),
        (10, "12 34 -- !!", "en", "a", 11), (None, body, "en", "a", 1), (None, None, None, None, None),
        (11, "É́ ünïcode ß 日本語 \x1c\x00 text", "es", "a", 1), (12, "x" * 30_000, "en", "a", 30_000),
        (13, prose(70, 3) + "\n" + body, "en", "a", 1), (14, "same " * 300, "en", "a", 1), (15, "same " * 200, "en", "a", 1),
    ]


def edge_docs(spark, clashes=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    for c in CLASHES if clashes else []:
        df = df.withColumn(c, F.lit("x"))
    return df


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def some_docs(spark, seed=5, n=60):
    """Prose with exact copies, near copies and shared passages."""
    r = random.Random(seed)
    rows = []
    passage = prose(70, 999)
    for i in range(n):
        kind = r.random()
        text = prose(r.randint(20, 260), 100 + i)
        if rows and kind < 0.15:
            text = r.choice(rows)[1].replace(" ", "  ")
        elif rows and kind < 0.4:
            words = r.choice(rows)[1].split()
            for _ in range(max(1, len(words) // 80)):
                words[r.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind < 0.5:
            text = text + " " + passage + " " + prose(30, 500 + i)
        rows.append((i, text, r.choice(["en", "de"]), "s", len(text)))
    return spark.createDataFrame(rows, SCHEMA), rows
