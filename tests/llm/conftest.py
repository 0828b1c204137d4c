import pytest

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key string, fp string, h int, "
           "size int, kept string, row string, `_id` int, `_mark` int, kind string, block int, target string, limit int")
EXTRA = ("x", "y", "z", 1, 2, "k", "r", 3, 4, "n", 5, "t", 6)


def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    rows = [
        (1, "The cat sat on the mat and looked at the dog.", "en", "b"),
        (2, "The  cat sat on the mat and\tlooked at the dog.", "en", "a"),
        (3, "the CAT sat on the mat and looked at the dog.", "en", None),
        (4, None, "en", "a"),
        (5, "", None, "b"),
        (6, " \t\n ", "fr", None),
        (7, "12345 67890 ... !!!", "fr", "a"),
        (8, "Le chat est assis sur le tapis et regarde le chien de la maison.", "fr", "c"),
        (8, "Le chat est assis sur le tapis et regarde le chien de la maison.", "fr", "c"),
        (8, "Le chien court dans la rue avec le chat et les enfants.", "fr", "c"),
        (None, "Le chat est assis sur le tapis et regarde le chien de la maison.", None, None),
        (None, None, None, None),
        (9, "x" * 200_000, None, "é"),
        (10, "word " * 60_000, "en", "b"),
        (11, "Ünïcödé 　 text \U0001f600   mixed \x85 spaces", "de", "c"),
        (12, "　", "de", "c"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small_docs):
    return small_docs.collect()
