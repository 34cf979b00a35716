"""Fill-in-middle against a plain version that counts code points, and SQL in DuckDB."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tapwise.llm import fill_middle, queries

from llm_rows import DOCS, odd_rows

MARKED = ["a <P> b", "<S>", "x<M", "<<P>>", "ends with <", "<P", ">S<", "P><S", "á\n\x00é🙂" * 40, "<" * 300, "S>" * 300, "M><" * 300]


def plain(doc_id, text):
    text = text or ""
    n, digest = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted([h1 % (n + 1), h2 % (n + 1)])
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return doc_id, n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


@pytest.mark.parametrize("match_units", [fill_middle.MATCH_UNITS, 7])
def test_forms_are_those_of_a_plain_version(spark, match_units):
    rows = odd_rows() + [(100 * k + i, text, None, None, 0) for k in range(1, 9) for i, text in enumerate(MARKED)]
    docs = spark.createDataFrame(rows, DOCS)
    formed = fill_middle.fill_in_middle(docs, match_units=match_units)
    found = formed.withColumn("text", fill_middle.restored(F.col("form"), F.col("output"))).collect()
    assert sorted(str(tuple(r)[:-1]) for r in found) == sorted(str(plain(r[0], r[1])) for r in rows)
    assert sorted(str((r.doc_id, r.text)) for r in found) == sorted(str((r[0], r[1] or "")) for r in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_other_units_are_kept_whole(spark):
    docs = spark.createDataFrame([(i, f"one two\n three  four{i} ") for i in range(60)], "doc_id long, text string")
    for units in (fill_middle.MATCH_UNITS, 2):
        formed = fill_middle.fill_in_middle(docs, unit=r"\s*\S+\s*?|\s+", match_units=units).collect()
        assert {r.n for r in formed} == {5}
        for r in formed:
            ends = {0, 3, 7, 14, 20 + len(str(r.doc_id)), 21 + len(str(r.doc_id))}
            assert r.form == "plain" or {r.prefix_chars, r.prefix_chars + r.middle_chars} <= ends
    with pytest.raises(Exception, match="not made of units"):
        fill_middle.Units("[a-z]", 10).ends("a1")
    with pytest.raises(ValueError, match="not made of units"):
        fill_middle.Units("[a-z]", 2).ends("ab1")


def test_a_text_longer_than_a_match_is_matched_in_turn():
    text = "é\n🙂x" * 3_000
    assert list(fill_middle.Units(".", 1_000).ends(text)) == list(range(1, len(text) + 1))


def test_unknown_forms_are_null(spark):
    rows = spark.createDataFrame([("psm", None), ("other", "x"), (None, "x")], "form string, output string")
    assert [r[0] for r in rows.select(fill_middle.restored(F.col("form"), F.col("output"))).collect()] == [None] * 3


def test_odd_tables(clashing, nothing):
    assert fill_middle.fill_in_middle(nothing).collect() == []
    named = clashing.withColumnsRenamed({"size": "n", "taken": "form", "score": "output"})
    found = sorted(str(tuple(r)) for r in fill_middle.fill_in_middle(named).collect())
    assert found == sorted(str(plain(r[0], r[1])) for r in odd_rows())


def test_query_is_that_of_its_sql(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_fill_in_middle(spark, str(tmp_path))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = db.sql(queries.ORACLES["op12_fill_in_middle"])
        assert want.columns == found.columns
        assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in found.collect())
