import random

import pytest

WORDS = {"en": "the and of to in is was for that with on are this be by".split(), "de": "der und die das nicht mit von ist ein auf für den zu sich".split()}


def text(lang: str, n: int, seed: int) -> str:
    rng = random.Random(seed)
    tails = "ing tion est ough ness" if lang == "en" else "ung keit schaft lich heit"
    return " ".join(rng.choice(WORDS[lang]) if rng.random() < 0.5 else rng.choice("b d f g k l m n".split()) + rng.choice("a e i o u".split()) + rng.choice(tails.split()) for _ in range(n))


ODD = [
    (900, None, "en", "s1", 0),
    (901, "", "en", None, 0),
    (902, " \n\t ", None, "s1", 0),
    (903, "12345 !!! ...", "en", "s2", 0),
    (None, "a text without an id of its own", "en", "s1", 0),
    (904, "é" * 5000 + " " + "long " * 20000, "en", "s1", 0),
    (905, "twice the same row", "en", "s1", 0),
    (905, "twice the same row", "en", "s1", 0),
    (906, "tie", "de", "s1", 0),
    (907, "tie", "de", "s1", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    out = [(i, text("en" if i % 3 else "de", 20 + i % 50, i), "en" if i % 3 else "de", f"s{i % 4}", 0) for i in range(120)]
    out += [(200 + i, out[5][1], "en", "s0", 0) for i in range(40)]  # a hot text
    out += [(300 + i, out[7][1] + f" tail{i}", "en", "s0", 0) for i in range(10)]
    return out + ODD


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Documents with nulls, ties, repeats, long texts, and columns whose names clash with results and inner names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("keep_id", "kept", "id", "body", "key", "h", "score", "component_id", "sequence_id", "rank", "topic"):
        df = df.withColumn(c, F.lit("clash"))
    return df.cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def sf(tmp_path):
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
