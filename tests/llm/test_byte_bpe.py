"""Byte-level BPE against the tiktoken library on whole texts, with chunks down to a few characters."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tapwise.llm import byte_bpe, queries

from llm_rows import DOCS, odd_rows
from test_tokens import ALPHABET

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
# Letters and numbers by some versions of Unicode only, contractions across any cut, and runs without any bound.
PARTS = [*ALPHABET, "'ll", "'re", "'", "''s", "l", "՘", "࢏", "\U000107bb", "\U00011de0", "\n \n", " \t ", "!!", "  x", "€"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(library, doc_id, text):
    ids = library.encode_ordinary(text or "")
    return doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def random_texts(seed, n):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(n)]
    return texts + ["a" * 500, " " * 300 + "b", "'" * 200 + "s" * 200, "1" * 90 + "\n" * 90, "x" * 70 + " " * 70 + "'ll" * 70]


def test_a_worker_sees_the_librarys_classes(library):
    words = byte_bpe.vocabulary(PATH, PATTERN)
    every = [chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x110000)]]
    # Between a letter and a digit, a character joins the one, the other or neither.
    for at in range(0, len(every), 20_000):
        text = "".join(f"a{c}1" for c in every[at : at + 20_000])
        ids = words.encode(words.pre_tokens(text))
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize(("chunk", "overlap"), [(1, 1), (2, 4), (7, 5), (16, 16), (16, 40)])
def test_stitched_bounds_are_those_of_the_whole_text(chunk, overlap):
    words = byte_bpe.vocabulary(PATH, PATTERN)

    def ends_of(text):
        return (m.end() for m in words.pattern.finditer(words.scanned(text)))

    for text in random_texts(chunk, 400):
        stitcher, found, at = byte_bpe.Stitcher(ends_of), [], 0
        for start in range(0, len(text), chunk):
            part, last = text[start : start + chunk + overlap], start + chunk >= len(text)
            ends = words.ends(part)
            ends = ends if last else ends[ends <= len(part) - byte_bpe.MARGIN_CHARS]
            for piece, cuts in stitcher.add(start, part, ends, last):
                found += [at + c for c in cuts]
                at += len(piece)
        assert found == words.ends(text).tolist(), repr(text)


def test_a_run_without_bounds_is_one_piece(library):
    """Scanned by the library, white space of this length ends its regular expressions."""
    words = byte_bpe.vocabulary(PATH, PATTERN)
    text = " " * 400_000 + "b"
    assert words.pre_tokens(text) == [" " * 399_999, " b"]
    ids = np.frombuffer(words.encode(words.pre_tokens(text)), "<u4").tolist()
    assert library.decode_bytes(ids) == text.encode()


@pytest.mark.parametrize("sizes", [(65_536, 1_024), (50, 12)])
def test_documents(spark, library, odd, sizes):
    texts = random_texts(5, 200)
    rows = odd_rows() + [(i // 2, text, None, None, 0) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = sorted(str(digests(library, r[0], r[1])) for r in rows)
    found = byte_bpe.round_trip(docs, PATH, PATTERN, *sizes).collect()
    assert sorted(str(tuple(r)) for r in found) == want
    encoded = byte_bpe.encode(docs, PATH, PATTERN, *sizes)
    pieces = byte_bpe.decode(encoded, PATH, PATTERN).orderBy("row", "piece").collect()
    ids, raw = {}, {}
    for r in pieces:
        ids[r.row, r.doc_id] = ids.get((r.row, r.doc_id), []) + np.frombuffer(r.ids, "<u4").tolist()
        raw[r.row, r.doc_id] = raw.get((r.row, r.doc_id), b"") + r.decoded
    got = sorted((str(doc_id), ids[row, doc_id], raw[row, doc_id].decode()) for row, doc_id in ids)
    assert got == sorted((str(r[0]), library.encode_ordinary(r[1] or ""), r[1] or "") for r in rows)


def test_odd_tables(spark, library, clashing, nothing):
    assert byte_bpe.round_trip(nothing, PATH, PATTERN).collect() == []
    assert byte_bpe.encode(nothing, PATH, PATTERN).collect() == []
    named = clashing.withColumnsRenamed({"size": "ids", "taken": "piece", "score": "chunk"})
    want = sorted(str(digests(library, r[0], r[1])) for r in odd_rows())
    assert sorted(str(tuple(r)) for r in byte_bpe.round_trip(named, PATH, PATTERN, 1_000, 30).collect()) == want


def test_query(spark, library, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op11_byte_bpe(spark, sf_dir)
    assert found.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(tuple, found.collect())) == sorted(digests(library, r.doc_id, r.text) for r in docs)
