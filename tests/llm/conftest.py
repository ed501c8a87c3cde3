import json

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    """name -> rows of the smallest tables."""
    return lambda name: pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of dicts -> a DataFrame with the columns of ``documents`` and others whose names clash."""
    def make(rows):
        columns = "doc_id long, text string, lang string, source string, n_chars long, shard string, `n` int, `text_crc32` int, `fp` int"
        return spark.createDataFrame([{"n": 7, **r} for r in rows], columns) if rows else spark.createDataFrame([], columns)
    return make


#: Null and empty texts, null ids, ties, repeated rows, a long text, null sources and languages.
ODD = [
    {"doc_id": 1, "text": None, "lang": None, "source": None},
    {"doc_id": 2, "text": "", "lang": "en", "source": "a"},
    {"doc_id": None, "text": "The quick brown fox jumps over the lazy dog while the band plays on and on", "lang": "en", "source": "a"},
    {"doc_id": 3, "text": "The quick brown fox jumps over the lazy dog while the band plays on and on", "lang": "en", "source": "b"},
    {"doc_id": 3, "text": "The quick brown fox jumps over the lazy dog while the band plays on and on", "lang": "en", "source": "b"},
    {"doc_id": 4, "text": "the quick brown fox jumps over the lazy dog while the band plays on and on!", "lang": None, "source": None},
    {"doc_id": 5, "text": " \t\r\n ", "lang": "fr", "source": "b"},
    {"doc_id": 6, "text": "a" * 300, "lang": "de", "source": "c"},
    {"doc_id": 7, "text": "mail bob.x@mail.example.com or 10.20.30.40, card 4111 1111 1111 1111, +1 (212) 555-0100 \U0001F600 é", "lang": "en",
     "source": "c"},
    {"doc_id": 8, "text": "größe und straße " * 4000, "lang": "de", "source": "d"},
    {"doc_id": -9, "text": "größe und straße " * 30, "lang": "de", "source": "d"},
    {"doc_id": 10, "text": "1234 5678 !!", "lang": "en", "source": "d"},
]


def plain(rows):
    return sorted((json.dumps(r, default=str) for r in rows))
