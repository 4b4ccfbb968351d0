import os
import shutil
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, hash int, row string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with columns whose names the operators also use inside; each row: (doc_id, text, lang, source)."""
    def make(rows):
        rows = [(*r, None, None, None)[:4] if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(*r[:4], None if r[1] is None else len(r[1]), "kept", 7, "row") for r in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows and ids, ties."""
    words = " ".join(f"wort{i * 7919 % 997} haus{i}" for i in range(9000))
    return [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
        (2, "the quick  brown fox jumps over the lazy dog", "en", "a"),
        (3, None, "en", "b"), (4, "", None, None), (None, "der Hund und die Katze", "de", None),
        (5, "12 !! 34", "de", "b"), (6, words, "de", "c"), (7, words + " ende", "de", "c"),
        (8, "<|endoftext|> \0 a\tb\n\n c  d", "fr", "a"), (8, "<|endoftext|> \0 a\tb\n\n c  d", "fr", "a"),
        (9, "le chat", "fr", "b"), (9, "la maison", "fr", "b"), (None, None, None, None), (10, "   \n\t ", "en", "a"),
    ]
