import random

import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # names that operators use inside
    " digest string, key int, version int, id int, row int, rate double, piece int, shard int, batch int, n_tokens int"
)


@pytest.fixture(scope="session")
def frame(spark):
    """(doc_id, text) pairs -> a documents frame with extra columns of clashing names."""

    def make(rows):
        full = [(d, t, "en", "s", len(t or ""), "x", 1, 2, 3, 4, 0.5, 5, 6, 7, 8) for d, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Distinct ids; null, empty and blank texts, ties, copies, near copies, repeated lines, one very long text."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    base = [word() for _ in range(130)]
    text = " ".join(base)
    near = " ".join(base[:60] + ["changed"] + base[61:])
    line = "A line that several documents share, of more than fifty bytes, with an é in it."
    long = " ".join(word() for _ in range(40_000)) + " " + text
    return [
        (0, None),
        (1, ""),
        (2, " \t\n"),
        (3, text),
        (4, text),
        (5, text.replace(" ", "  ")),
        (6, near),
        (7, "one two"),
        (8, "One Two"),
        (9, "x\n" + line + "\ny"),
        (10, line + "\n" + line),
        (11, long),
        (12, "\U0001f600 " + line.upper() + " token = 'abcdefgh'"),
        (13, "a b c d e"),
        (14, "a b c d e f"),
        (15, " ".join(["und"] * 120)),
        (16, "### " * 90),
        (-7, line),
        (1 << 40, text[:400]),
    ]


@pytest.fixture(scope="session")
def no_id_rows():
    """Null ids, ids given twice to different texts, and rows repeated as they are."""
    text = " ".join(f"word{i}" for i in range(60))
    return [(None, text), (None, "other text " + text), (5, text), (5, text), (5, "different"), (None, None), (None, text)]
