"""Small tables with the awkward rows that every operator must take."""

import random
from pathlib import Path

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # columns whose names clash with what the operators return or use inside
                     *[T.StructField(c, T.StringType()) for c in ("n_words", "kept", "size", "_text", "_key", "_doc", "_row", "spans", "id", "key", "n", "sig")]])


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeinorstuéß") for _ in range(rng.randint(2, 9))) for _ in range(n))


def documents(seed=5):
    """Nulls, empty and long texts, copies, near copies, repeated rows and repeated ids."""
    rng = random.Random(seed)
    base = words(rng, 120)
    texts = [None, "", " \n\t ", "one", "two words", "three little words", words(rng, 20_000), "x" * 60_000, "é" * 50, base, base, base.upper()]
    for k in (1, 2, 3, 30):
        w = base.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [f"line one is here now\nline one is here now\n{words(rng, 30)}", "a b c d e " * 40, "### $$$ %%% &&& " * 20, "mail me at a.b@mail.example.org or +1 (222) 555-7713 now",
              "4111 1111 1111 1111 and 10.0.0.255 and 10.0.0.256", "Released under the MIT License.\nCC BY-NC 4.0 and Apache License, Version 2.0"]
    texts += [words(rng, rng.randint(1, 60)) for _ in range(40)]
    extra = ["clash"] * 12
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["s1", "s2", "s2", "s3", None]), len(t or ""), *extra) for i, t in enumerate(texts)]
    rows += [rows[9]] * 6 + [rows[0]] + [(None, "no id here at all " * 3, None, None, None, *extra)] * 2
    return rows


def save(spark, path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(str(Path(path) / f"{name}.parquet"))
    return str(path)


def folder(spark, path, rows=None):
    rows = documents() if rows is None else rows
    labels = [(r[0], int("###" not in (r[1] or "") and "a b c d e a" not in (r[1] or "")), 0) for r in rows] + [(None, 1, 0), (3, None, None)] if rows else []
    return save(spark, path, documents=(rows, DOCS), labels=(labels, "doc_id long, quality int, toxic int"))
