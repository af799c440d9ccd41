import pytest


@pytest.fixture
def documents(spark):
    """Makes documents from (doc_id, text) or (doc_id, text, source), with columns that clash with internal names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", 1, "x", -1) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, source string, n_chars long, digest string, size int"
        )

    return make


@pytest.fixture
def work(spark):
    from lakemart.llm.tables import workspace

    space = workspace(spark)
    yield space
    space.close()


def words(seed, n, vocabulary=400):
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, changes):
    import random

    rng = random.Random(seed)
    parts = text.split(" ")
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = f"e{rng.randrange(10**6)}"
    return " ".join(parts)
