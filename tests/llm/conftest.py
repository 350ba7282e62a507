import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or give out.
CLASHING = "simhash string, component_id string, ids string, spans string, size string, target string, fingerprint string, toxic string, key string, mark string, `a.b` string"


@pytest.fixture(scope="session")
def frames(spark):
    """Makes a frame of documents from texts; ids count up."""

    def make(texts, source="s", first=0):
        rows = [(first + i, t, "en", source if isinstance(source, str) else source[i], len(t) if t is not None else None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty and very long texts, null ids and sources, ties, repeated rows, columns with clashing names."""
    long = "word other thing " * 20_000
    rows = [
        (1, "a b c d e f g", "en", "s", 13),
        (1, "a b c d e f g", "en", "s", 13),
        (2, None, None, None, None),
        (3, "", "en", "s", 0),
        (4, " \n\t ", "en", None, 4),
        (None, "a b c d e f h", "de", "t", 13),
        (5, long, "en", "t", len(long)),
        (6, "A B C D E F G", "en", "t", 13),
        (7, "mail me at x.y@z.org, 10.0.0.1 😀 é", "fr", "u", None),
    ]
    names = [f.split()[0] for f in CLASHING.split(", ")]
    return spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], f"{DOCUMENT}, {CLASHING}")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
