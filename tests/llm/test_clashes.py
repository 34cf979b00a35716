"""Further columns, called as those that the operators make, change nothing; nor does a very long turn."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapwise.llm import chat, mixing, multi_index, packing, token_files

from test_operators import BYTES, WORDS


def rows(frame):
    return sorted(map(str, map(tuple, frame.collect())))


@pytest.fixture(scope="module")
def crowded(odd):
    names = """size taken shard rank ring own _text_md5 _total shards quota words piece start length ids offset sequence_id group
        file row n_tokens part kind ids_crc32 task""".split()
    return odd.select("*", *[F.lit(f"x {n}").alias(n) for n in names])


def test_mix(odd, crowded):
    columns = ["doc_id", "source", "size", "source_size", "target", "shard", "taken"]
    assert rows(mixing.mix(crowded).select(*columns)) == rows(mixing.mix(odd).select(*columns))


def test_packing(odd, crowded):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(packing.pack(crowded, BYTES, 2).select(*columns)) == rows(packing.pack(odd, BYTES, 2).select(*columns))


def test_token_files(odd, crowded):
    found = [token_files.read_token_files(token_files.write_token_files(docs, WORDS, 1)) for docs in (odd, crowded)]
    assert rows(found[0].select("doc_id", "start", "n_tokens")) == rows(found[1].select("doc_id", "start", "n_tokens"))


def test_chat_and_a_very_long_turn(spark):
    text = "\\### <turn> é🙂: " * 30_000
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    records = chat.table_records(turns).selectExpr("*", "1 AS layout", "2 AS fingerprint", "3 AS formatted", "4 AS loss_start")
    canonical = chat.canonical_turns(records)
    formatted = chat.format_turns(canonical.selectExpr("*", "5 AS formatted", "6 AS loss_end"))
    (found,) = chat.read_back(formatted.selectExpr("*", "7 AS n_turns")).collect()
    assert (found.n_turns, found.loss_chars) == (2, len(text))
    assert found.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 8))
    made = [(i, (base[i % 30] + 0.05 * rng.standard_normal(8)).tolist()) for i in range(120)]
    plain = spark.createDataFrame(made, "vec_id long, embedding array<float>")
    named = plain.selectExpr("*", *[f"'x' AS {n}" for n in "v cells root node n_links component_id kept number draw cell".split()])
    assert rows(multi_index.near_duplicates(named, least=0.95)) == rows(multi_index.near_duplicates(plain, least=0.95))


def test_a_sample_is_not_filled_by_rows_of_one_id(spark):
    """A third of all rows share an id; equal rows count once."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((300, 8))
    made = [(7 if i % 3 == 0 else i, (base[i % 300] + 0.02 * rng.standard_normal(8)).tolist()) for i in range(900)]
    frame = spark.createDataFrame(made + made[:3] * 50, "vec_id long, embedding array<float>")
    found = multi_index.near_duplicates(frame, least=0.95, sample_rows=64)
    assert found.where("n_links > 0").count() >= 0.97 * (900 + 150)
