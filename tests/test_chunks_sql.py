"""Chunks of documents in which last digits and places decide, against DuckDB."""

import duckdb
import pytest

from lexloom.functions import vectors as V
from lexloom.plans import queries as plans

WORDS = "aa bb cc dd ee ff".split()
# Words of neighbouring sentences whose cosine is 47 / 100: as 47 / (|a| |b|), at 0.47 or just under it; unit vectors say otherwise.
PAIRS = [([3, 3, 3, 6, 1, 6], [1, 3, 8, 0, 5, 1]), ([3, 3, 6, 4, 1, 3], [0, 8, 0, 0, 5, 6]), ([0, 4, 3, 3, 0, 4], [9, 5, 6, 3, 7, 0]), ([1, 1, 6, 0, 1, 1], [10, 0, 4, 7, 6, 7])]
# A dropped chunk of less than 100 characters, inside which the next one's text begins.
LINES = ["Wac wad wae.", "Wae wad waa wab waa waa.", "Waf waa waf wad wab waf."]
REPEATED = " ".join(LINES[int(i)] for i in "010101111110111102102")


def sentence(counts):
    return " ".join(w for w, n in zip(WORDS, counts, strict=True) for _ in range(n)).capitalize() + "."


def same_as_sql(spark, tmp_path, name, texts):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{path}/*.parquet'")
    result = duck.execute(plans.oracle_sql()[name])
    names = [d[0] for d in result.description]
    got = plans.queries()[name](spark, str(tmp_path)).select(*names).collect()
    assert sorted(tuple(r) for r in got) == sorted(result.fetchall())


@pytest.mark.parametrize("name", ["role_chunks", "semantic_chunks"])
def test_cosines_at_the_threshold(spark, tmp_path, name):
    assert len(set(V.hashed_counts(WORDS).argmax(axis=1))) == len(WORDS)
    same_as_sql(spark, tmp_path, name, [" ".join(sentence(x) for x in (a, a, b, b)) for a, b in PAIRS])


def test_places_pass_over_dropped_chunks(spark, tmp_path):
    same_as_sql(spark, tmp_path, "role_chunks", [REPEATED])
