import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("rid", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("epoch", T.StringType()),
    T.StructField("_t", T.StringType()), T.StructField("a.b", T.StringType()), T.StructField("block", T.StringType()),
])


def _texts():
    r = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    make = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, base = make(60), make(120)
    rows = [(k, " ".join(make(r.randint(40, 90)))) for k in range(12)]
    rows += [(20 + k, " ".join(make(30) + passage + make(25))) for k in range(4)]  # a shared passage
    for k in range(8):  # near copies, from close to far
        w = list(base)
        for j in r.sample(range(len(w)), 2 * k):
            w[j] = r.choice(vocabulary)
        rows.append((40 + k, " ".join(w).upper() if k == 1 else " ".join(w)))
    rows += [(60 + k, " ".join(base)) for k in range(3)]  # exact copies
    rows += [(70, None), (71, ""), (72, " \t\n "), (73, "one"), (74, "One"), (75, "two words"), (None, " ".join(base)), (None, None)]
    rows += [(80, "x " * 300), (81, " ".join(passage[:40])), (82, "\n".join(["same line here"] * 9)), (83, " ".join(passage + make(5) + passage))]
    rows += [(90, " ".join(make(9000))), (12, "repeated row " * 4), (12, "repeated row " * 4), (11, " ".join(make(50)))]
    return rows


@pytest.fixture(scope="session")
def rows():
    return _texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    data = [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), "r", "n", "e", "t", "b", "k") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
