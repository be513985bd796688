import random

import pytest

SYLLABLES = "an er on the lo mi ra te vo ki da su".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(f"x{rng.randint(0, 999)}" if rng.random() < share else w for w in text.split(" "))


def rows_of(texts: list, first: int = 0) -> list[tuple]:
    return [(first + i, t, "en", f"src{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]


@pytest.fixture
def frame(spark):
    """A documents table from texts, with extra columns whose names clash with derived ones."""

    def make(rows, extra: bool = True):
        rows = rows if rows and isinstance(rows[0], tuple) else rows_of(rows)
        df = spark.createDataFrame(rows, DOCS)
        if extra:
            from pyspark.sql import functions as F

            for c in ("size", "key", "n", "score", "spans", "length", "component_id", "kept", "start", "at", "comp", "target", "rule"):
                df = df.withColumn(c, F.lit("clash"))
        return df

    return make


#: Null, empty, blank, short, repeated, odd and long texts.
EDGES = [None, "", "  \n\t ", "a", "a b c d", "a b c d", prose(1, 40), prose(1, 40), "ÀÉ ß 日本語   x", prose(2, 4000), "x" * 30_000, "a " * 3000]
