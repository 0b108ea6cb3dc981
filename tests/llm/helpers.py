"""Small documents with every awkward case, and brute-force twins of the operators."""

import random

import duckdb

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(sf=SF):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


def frame(spark, rows, extra=True):
    """A documents table from ``(doc_id, text)``, with columns whose names operators use inside."""
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    if extra:
        from pyspark.sql import functions as F
        for c in ("h", "k", "at", "component_id", "kept", "spans", "__text", "__h"):
            df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)


AWKWARD = [
    (None, "no id. no id either. nothing at all. nothing to see here for anyone. one two three four."),
    (1, None), (2, ""), (3, " \t\n "), (4, "x"),
    (5, "One two three four five six. Seven eight nine ten eleven. Twelve."),
    (5, "One two three four five six. Seven eight nine ten eleven. Twelve."),
    (6, "one two three four five six. seven eight nine ten eleven. Other end."),
    (7, "é" * 300 + "\u0000" + "日本" * 40 + "\U0001F600"), (8, "é" * 300),
    (9, "a" * 700), (10, "ab" * 400 + "\n" + "ab" * 400),
    (11, "word " * 3000), (12, None), (13, ""),
]


def mutated(seed=0, n=40):
    """Documents that share passages of all lengths around the thresholds."""
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"é{i}" for i in range(60)]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 60))) + rng.choice([".", "!\n", ", "]) for _ in range(12)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(" ".join(rng.choices(words, k=rng.randint(0, 12))) + rng.choice([". ", "\n", " "]))
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 3) if rng.random() < 0.5 else 0
            parts.append(p[cut:])
        out.append((i * 3 + 100, "".join(parts)))
    return out


def near_texts(text, n, seed=2):
    """Copies of ``text`` with more and more words changed."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = text.split()
        for _ in range(i):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out
