import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, fingerprint string, spans string"

LONG = " ".join(f"word{k % 997}" for k in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here", "en"),
    (2, None, "en"),
    (3, "", "de"),
    (4, "   \n\t ", None),
    (5, LONG, "en"),
    (6, "x" * 20_000, None),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund und läuft weit weg von hier", "de"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund und läuft weit weg von hier", "de"),
    (None, "No identifier here, mail me at someone@example.com or call +49 30 1234567 today please", "en"),
    (None, None, None),
    (8, "1234567890 !!! ### 42", None),
    (9, "日本語のテキスト と 🙂 ß É <|endoftext|> ▁▁ end", "und"),
    (10, "The quick brown fox jumps over the lazy dog and runs far away from here", "en"),
]


@pytest.fixture(scope="session")
def texts():
    return TEXTS


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, lang, "s", None, 5, True, "f", "x") for i, t, lang in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where(F.lit(False))


@pytest.fixture(scope="session")
def by_id():
    def collect(frame, key="doc_id"):
        out: dict = {}
        for row in frame.collect():
            out.setdefault(row[key], []).append(row)
        return out

    return collect


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"

