import random

import duckdb
import pytest
from pyspark.sql import Row

# columns no operator asks for, named like ones that operators make
CLASHING = {"id": 7, "key": "k", "n_words": -1, "score": 9.5, "node": 3, "tokens": "t", "rule": "r", "shard": 99, "kept": "x",
            "place": 5, "row": "w", "head": 1, "item": "i"}
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              + ", ".join(f"{k} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}"
                          for k, v in CLASHING.items()))


def doc(doc_id, text, lang="en", source="s"):
    return Row(doc_id, text, lang, source, None if text is None else len(text), *CLASHING.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, DOC_SCHEMA)


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


@pytest.fixture(scope="session")
def passage():
    return words(1, 40)


@pytest.fixture(scope="session")
def odd_docs(spark, passage):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_text = words(2, 2500, 1500)  # the SQL form copies a text for each word; test_native has a really long one
    rows = [doc(1, None), doc(2, ""), doc(3, " \t\n \x0b "), doc(4, long_text), doc(5, long_text + " more"),
            doc(6, "Über Ärger É!"), doc(6, "Über Ärger É!"), doc(7, "one two"), doc(7, "another text of id seven"),
            doc(8, passage.upper()), doc(9, passage + ". " + words(3, 30)), doc(None, passage), doc(None, None),
            doc(10, words(4, 100), None, None), doc(11, words(4, 100), "fr", None), doc(12, words(4, 100) + " end", None, "s"),
            doc(13, "a\u00a0b \u3000 漢字 العربية \U0001f600 \x00 z"), doc(14, "l1\nl1\n\nl2\nl1\n" + words(5, 60)),
            doc(15, "# * $ %% && ||| <> " * 40), doc(16, "x " * 500)]
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def odd_benchmark(spark, passage):
    return spark.createDataFrame([(1, passage), (1, passage), (2, "ONE two"), (3, None), (4, ""), (None, words(4, 100)),
                                  (5, " ".join(passage.split()[:14])), (6, "漢字")], "item_id long, text string")


def oracle(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con.sql(sql).fetchall(), [d[0] for d in con.sql(sql).description]


def same(df, sql, **tables):
    """Spark's rows are those of the SQL, whatever their order."""
    rows, names = oracle(sql, **tables)
    assert df.columns == names
    order = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, df.collect()), key=order) == sorted(map(tuple, rows), key=order)
