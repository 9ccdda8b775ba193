import pytest

LONG = 60_000  # words of the very long text

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key_ string, weight string, n long"


def prose(seed: int, words: int, stock: int = 700) -> str:
    """Repeatable invented words; different seeds share few 3-word runs."""
    state, out = seed * 7919 + 13, []
    for i in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{(state >> 8) % stock}" + (".\n" if i % 17 == 16 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with every awkward case, and columns whose names clash with inner ones."""
    base = prose(1, 120)
    edited = base.split(" ")
    edited[60] = "changed"
    texts = [
        base,
        base,
        " ".join(edited),
        None,
        "",
        " \n\t ",
        "one",
        "Two words",
        "same same same same same same",
        prose(2, LONG),
        prose(3, 200) + " Mail a.b@c.example.org or +1 (212) 555-0199, host 10.0.0.255.",
        "x" * 5_000,
        "Ünï¢ödé ñandú 日本語 " * 30,
        "line\nline\nline\n" * 10,
        prose(4, 90) + "\nLicensed under CC BY-NC 4.0.\nAll rights reserved.",
    ]
    rows = [
        (i, t, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], None, "k", "w", 7)
        for i, t in enumerate(texts)
    ]
    return rows + [rows[0], rows[14], (None, base, "en", "a", None, "k", "w", 7)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
