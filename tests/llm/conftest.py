import random

import pytest

BPE = "byte_bpe_50k.json"


@pytest.fixture(scope="session")
def words():
    rnd = random.Random(7)
    return ["".join(rnd.choices("abcdeéßio", k=rnd.randint(2, 7))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd(spark, words):
    """Null, empty, very long and repeated texts, ties, null ids, clashing columns."""
    rnd = random.Random(3)
    base = " ".join(rnd.choices(words, k=120))
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one"),
        (8, " ".join(rnd.choices(words, k=30000))), (9, "x" * 50000), (10, "a b c\na b c\na b c\n" * 30),
        (11, "Mail Anna.B@mail.example.com, +1 (234) 567-8901, 10.0.0.255, 10.0.0.256, 4111 1111-1111 1111!"),
        (12, base), (12, base), (None, base), (None, None), (13, "日本語 のテキスト です。" * 20),
        (14, "### *** $$$ %%% " * 40),
    ]
    rows = [(i, t, "en" if i and i % 2 else None, None, 7, 1, "fp", [1], 0.5, "own", "kept") for i, t in texts]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, tag int, fp string, "
              "ids array<int>, score double, component_id string, starts string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
