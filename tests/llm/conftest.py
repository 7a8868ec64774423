import zlib

import pytest


@pytest.fixture(scope="session")
def tricky(spark):
    """Documents with nulls in every column, empty and long texts, repeated
    rows and a column of a clashing name."""
    rows = [(1, "The cat sat on the mat and the dog ran to the house", "en", "a", 1, 0.5),
            (1, "The cat sat on the mat and the dog ran to the house", "en", "a", 1, 0.5),
            (2, None, None, None, None, None), (3, "", "en", "a", 0, 0.1), (4, " \n\t ", "fr", None, 4, 0.1),
            (None, "Un texte sans numéro <|endoftext|> fin", "fr", "b", 9, None), (6, "!!! 123 ???", None, "b", 3, 0.0),
            (7, "word " * 30_000, "en", "b", 2, 1.0), (8, "x" * 20_000, None, "c", 2, 1.0),
            (9, "Der Hund läuft über die Straße und bellt", "de", "c", 2, 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, SCORE double")


def crc(key, n):
    return zlib.crc32(str(key).encode()) % n
