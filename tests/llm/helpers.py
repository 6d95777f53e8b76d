"""Small tables for the operators' tests."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHING = {"id": 1, "_id": "x", "_k": 2, "key": "k", "kept": True, "component": 5, "h": 6, "start": 7,
            "score": 0.5, "c0": 8, "u": 9, "words": "w", "base": "b", "item": 3, "_t": "t"}


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    if clashing:
        from pyspark.sql import functions as F
        df = df.withColumns({k: F.lit(v) for k, v in CLASHING.items()})
    return df


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]
