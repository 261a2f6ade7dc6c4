import pytest

from placelake.llm.common import Scratch

#: Names that operators use inside, to clash with.
EXTRA = ["_id", "_h", "_row", "_text", "host", "node", "row", "key", "label", "word"]
BASE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns of clashing names."""

    def make(rows):
        full = []
        for r in rows:
            i, text, lang, source = (*r, "en", "src0")[:4] if len(r) == 2 else r
            full.append((i, text, lang, source, None if text is None else len(text), *["x"] * len(EXTRA)))
        return spark.createDataFrame(full, BASE + "".join(f", {c} string" for c in EXTRA))

    return make


@pytest.fixture
def edge_docs(make_docs):
    """Null id, null text, null language and source, empty text, white space alone, a long text, repeated rows and ids."""
    long = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
    return make_docs([
        (None, "a text without an id", "en", "src0"), (1, None, "en", "src0"), (2, "", None, None), (3, " \t\n ", "fr", None),
        (4, long, "en", "src1"), (5, "same row twice, word for word", "de", "src1"),
        (5, "same row twice, word for word", "de", "src1"), (6, "one id, two texts", "en", "src0"),
        (6, "another text of that id", "en", "src0"), (7, "x" * 5000, "en", "src0"), (8, "ünï çødé ✓ 𝔘", "de", "src0"),
    ])


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.filter("false")
