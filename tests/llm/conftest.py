import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that operators might use for columns of their own
CLASHES = ["n_words", "key", "spans", "near", "measures", "verdict", "secrets", "dedup", "_spans", "DIGEST", "ids", "class_id"]


def prose(rnd, n):
    return " ".join("".join(rnd.choice("aeioustrnlé") for _ in range(1 + rnd.randrange(7))) for _ in range(n))


def edited(rnd, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rnd.randrange(len(words))] = "edit" + str(rnd.randrange(10**6))
    return " ".join(words)


def documents():
    """Ordinary documents, copies, near copies, shared passages, and every awkward case."""
    rnd = random.Random(7)
    own = [prose(rnd, n) for n in (30, 80, 120, 200, 60, 400, 55, 150)]
    passage = prose(rnd, 70)
    texts = list(own)
    texts += [own[2], own[2], edited(rnd, own[3], 2), edited(rnd, own[5], 12), edited(rnd, own[5], 60)]
    texts += [prose(rnd, 20) + " " + passage + "\n" + prose(rnd, 25) for _ in range(3)]
    texts += ["", " \n\t ", None, "word", "one two three four", "one two three four", "x" * 3000, "ab" * 300, "na " * 200]
    texts += [passage, own[0].upper(), " nbsp em " + own[4], own[6].replace(" ", "\r\n"), "\U0001f600 " * 60]
    line = prose(rnd, 12)
    texts += ["\n".join([line, prose(rnd, 9), line, "", line]), prose(rnd, 5000), "#$% " * 30 + prose(rnd, 10)]
    rows = [(i, t, ("en", "fr", None)[i % 3], "src0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, own[1], None, None, None), (None, None, None, None, None)]  # repeated rows, null ids
    return rows


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.select("*", *[F.lit("mine").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(frame, *columns):
    """Sorted tuples of the given columns, nulls first."""
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def listed(tuples):
    return sorted(tuples, key=repr)
