import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "re on the ti er an st ou nd ing es ed ly ble a of ca mo".split()


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus(seed: int = 5) -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empties, ties and long texts."""
    rng = random.Random(seed)
    texts: list[str | None] = [" ".join(words(rng, rng.randint(20, 220))) for _ in range(40)]
    passage = " ".join(words(rng, 60))
    for i in range(0, 12):
        texts[i] = f"{texts[i][:rng.randint(0, 300)]} {passage} {texts[i][300:]}"
    for i in range(12):  # near copies, some of near copies
        w = texts[20 + i // 3].split()
        for _ in range(1 + i % 3):
            w[rng.randrange(len(w))] = "zebra%d" % i
        texts.append(" ".join(w))
    texts += [texts[30]] * 6 + [texts[31].upper()]
    texts += [None, "", " ", "\n\t ", "one", "One two", "one two three four", "x" * 49, "y" * 50, "y" * 50, "y" * 300]
    texts += ["ab" * 4000, "é" * 700 + " " + "é" * 700, " ".join(words(rng, 12000)), "tab\tand\x0bodd\x0cblank\x85x　y"]
    texts += ["Released under the MIT License. " * 3, "SPDX-License-Identifier: Apache-2.0", "Apache License, Version 2.0",
              "CC BY-NC 4.0, cc-by-nc; cc by nc sa", "GNU General Public License version 3 or later"]
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s1", "s2", "é", None]), len(t or ""))
            for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def ws(spark):
    from surgeflow.llm.common import Workspace
    with Workspace(spark, "test") as w:
        yield w


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, repeated rows, and columns named as the operators name theirs."""
    data = [(1, "alpha beta gamma", "en", "s", 1), (1, "alpha beta gamma", "en", "s", 1), (None, None, None, None, None),
            (None, "alpha beta gamma", None, "s", 3), (2, None, "en", None, 0), (3, "", "fr", "t", 0)]
    clash = ["rid", "block", "body", "ord", "row", "size", "score", "rank", "cell", "kept", "_id", "place", "text_crc32"]
    schema = DOC_SCHEMA + ", " + ", ".join(f"{c} string" for c in clash)
    return spark.createDataFrame([(*r, *["?"] * len(clash)) for r in data], schema)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
