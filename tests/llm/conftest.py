import random

import pytest

WORDS = "the of and to in thon erea blewh sting anor tion heou rest inly ndre hatha edor shble onti wher".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "er", "ing", str(rng.randint(0, 99))]) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """A small documents table with nulls, empty and long texts, repeats, ties and columns of clashing names."""
    base, other = prose(1, 300), prose(2, 120)
    near = base.split()
    near[150] = "changed"
    rows = [
        (1, base),
        (2, base.upper()),
        (3, " ".join(near)),
        (4, other + " " + base[:900]),
        (5, None),
        (6, ""),
        (7, "   \n\t "),
        (8, "short text"),
        (8, "short text"),
        (9, prose(3, 6000)),
        (10, "=" * 5000),
        (11, "a b c d e " * 200),
        (12, "line one here\n" * 40),
        (13, prose(4, 80) + " mail x.y@mail.example.com or +1 (555) 123-4567, card 4111 1111 1111 1111 at 10.0.0.7"),
        (14, "é ﬁ 日本 😀 ▁x don't we'll <|endoftext|> Σας"),
        (None, "no id"),
        (None, base),
        (15, "Released under the MIT License.\n" + prose(5, 60)),
    ]
    # names that the operators use inside
    return spark.createDataFrame(
        [(i, t, "a", i, 1, "x") for i, t in rows],
        "doc_id bigint, text string, sha string, row bigint, n int, bands string",
    )


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (4, 1, 0), (9, 1, 0), (10, 0, 0), (None, 1, 0), (3, None, None)],
        "doc_id bigint, quality int, toxic int",
    )
