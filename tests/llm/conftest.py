from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _row string, _key long, _spans string, "
          "n_words int, kept boolean, stratum string, fp long, part int")


def prose(seed: int, n: int, words=("the", "of", "tree", "river", "stone", "and", "light", "hollow", "march", "under")) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randrange(40)).replace("0", "a").translate(str.maketrans("123456789", "bcdefghij")) for _ in range(n))


def texts() -> list[str | None]:
    base = [prose(i, 60) for i in range(30)]
    return [None, "", " \n\t ", "one", "one two", "aé中 \U0001F600 z.", prose(99, 30000), *base, *base[:5], base[0] + " extra",
            "x\n\nx\n y \nx", "mail bob@example.com, ip 10.0.0.1 or 300.1.1.1, call +1 (555) 010-2030!", "\x00\x1f odd   space"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, word-less, very long and repeated texts, repeated rows, a null id, columns with clashing names."""
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", None if t is None else len(t), "r", 7, "s", 1, True, "q", 9, 3)
            for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[10], rows[10], (None, *rows[11][1:]), (None, *rows[0][1:])], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
