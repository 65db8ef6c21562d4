import random

import pytest

WORDS = "the of and a to in is was he for it with as his on be at by I that Ärger naïve 中文 x1 42".split()


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) + str(r.randint(0, 400)) * (r.random() < 0.7) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with copies, near copies, shared passages, nulls, empty
    and very long texts, ties and repeated rows."""
    r = random.Random(4)
    rows = [(i, prose(r, r.randint(1, 120))) for i in range(60)]
    base = [t for _, t in rows]
    for i in range(60, 75):  # exact copies but for white space
        rows.append((i, base[i % 7].replace(" ", r.choice([" ", "  ", "\n", "\t"]))))
    for i in range(75, 110):  # near copies
        words = base[20 + i % 5].split()
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = "edit"
        rows.append((i, " ".join(words)))
    shared = prose(r, 30)
    for i in range(110, 130):  # one passage in many documents
        rows.append((i, prose(r, r.randint(0, 60)) + " " + shared + " " + prose(r, r.randint(0, 60))))
    rows += [(130, None), (131, ""), (132, " \t\n"), (133, "one two"), (134, "ONE two"), (135, prose(r, 30_000)),
             (136, "a" * 50_000), (137, "b " * 3000), (138, None), (3, rows[3][1]), (3, rows[3][1]), (-5, base[2]),
             (139, "<|endoftext|> 'LL Σας ÉA é " + "z" * 300)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus as a table with extra columns of clashing names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    return df.select("*", F.lit("en").alias("lang"), F.lit(1).alias("kept"), F.lit("d").alias("digest"),
                     F.lit(2).alias("row"), F.lit(None).cast("int").alias("places"), F.lit("x").alias("_id"))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
