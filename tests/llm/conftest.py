"""Small frames for the corpus operators, and a way to make them."""

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, shard int, __block string, ids string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text[, lang, source]) with columns whose names operators use themselves."""

    def make(rows):
        whole = []
        for row in rows:
            doc, text, lang, source = (*row, None, None)[:4]
            whole.append((doc, text, lang, source, None if text is None else len(text), 7, "x", None))
        return spark.createDataFrame(whole, COLUMNS)

    return make


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [tuple(r) for r in docs.collect()]


WORDS = "amber birch cedar delta ember fjord grove hazel inlet jewel knoll larch maple north ocean pearl quartz river stone tulip".split()


def passage(n, step=1, start=0):
    """``n`` words in a fixed order that repeats no short run."""
    return " ".join(f"{WORDS[(start + i * step) % 20]}{(start + i) % 97}" for i in range(n))


def collected(df, *names):
    """Rows as tuples of the named columns, in order."""
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
