import random
import re

import pytest

SF = "/root/testdata/sf0.001"
WS = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in WS.split(text or "") if w]


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, texts, extra=True, lang="en"):
    """A documents table; ``extra`` adds columns whose names operators use."""
    rows = [(i, t, lang, "src0", len(t or "")) for i, t in texts]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        for c in ("size", "node", "h", "shard", "score", "t", "rate", "value"):
            df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = prose(120)
    near = base.split()
    near[60] = "changed"
    return [(0, None), (1, ""), (2, " \t\n"), (3, base), (4, base), (4, base), (5, base.replace(" ", "\n", 3)), (6, " ".join(near)), (7, prose(30_000)),
            (8, "one"), (9, "ONE"), (10, "one two"), (None, base), (None, None), (11, "漢字 🙂 é ß" * 5), (12, prose(90)), (12, prose(80)), (13, prose(40) + "\x85 \xa0x")]
