import random

import public_tokenizers
import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    """A maker of random text from a fixed invented vocabulary."""
    random_words = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzéü"
    pool = ["".join(random_words.choices(letters, k=random_words.randint(2, 9))) for _ in range(3000)]

    def make(seed, n):
        return " ".join(random.Random(seed).choices(pool, k=n))

    return make


@pytest.fixture(scope="session")
def tricky(words):
    """Rows with every odd case: NULLs, empty, blank, long, ties, repeated rows, odd characters."""
    long_text = words(1, 9_000)
    base = words(2, 300)
    edited = " ".join(w if i % 40 else f"x{i}" for i, w in enumerate(base.split()))
    passage = words(3, 70)
    rows = [
        (1, None, "en", None, None),
        (2, "", None, "s", 0),
        (3, " \n\t \n", "en", "s", 5),
        (4, "One", "en", "s", 3),
        (5, "one", "de", None, 3),
        (6, long_text, None, "s", 1),
        (7, base, "en", "s", 2),
        (8, edited, "en", "s", 2),
        (9, base.upper(), "en", "s", 2),
        (10, base, "en", "s", 2),
        (11, words(4, 60) + " " + passage + " " + words(5, 60), "fr", "s", 9),
        (12, words(6, 80) + "\n" + passage + "  " + words(7, 40), "fr", "s", 9),
        (13, passage, None, None, None),
        (14, "▁a  b▁ ▁ c \U0001f600 <s> <|endoftext|> ŉ İ ǅ é \u0000 é's it's 12,3!! ", "xx", "s", 1),
        (15, "x" * 50_000, "en", "s", 1),
        (16, "This is under the MIT License. The Apache license, Version 2.0; GNU General\nPublic License 3", "en", "s", 1),
        (17, "mit license " * 40, "en", "s", 1),
        (18, "ñandú; straße 漢字 слово", "es", "s", 1),
        (19, "same line\nsame line\n\nsame line\r\nother | # $ * line", "en", "s", 1),
    ]
    rows += [(20 + i, f"Page {i} of the site number {i}\n{words(100 + i, 30)}", "en", "s", 1) for i in range(14)]
    rows += [(40 + i, f"Posted by {words(200 + i, 1)} in the town today\n{words(300 + i, 30)}", "en", "s", 1) for i in range(12)]
    return rows


@pytest.fixture
def documents(spark, tricky):
    return spark.createDataFrame(tricky, DDL).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def vocabulary_path():
    return public_tokenizers.path
