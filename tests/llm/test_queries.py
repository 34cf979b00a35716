"""The registered queries themselves, with their own parameters, against brute force over whole tables."""

import hashlib
import os
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pytest

from tapwise.llm import queries, scratch

from test_operators import BYTES, WORDS, crc, plain_components, plain_fingerprint, plain_ids


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]


def test_op2_cuts_only_what_is_too_long_and_fills_sequences(spark, sf_dir, docs):
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in queries.op2_best_fit_packing(spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    for doc_id, text in docs:
        ids, own = plain_ids(BYTES, text, 2), sorted(pieces.pop(doc_id), key=lambda r: r.piece)
        total += len(ids)
        assert [r.piece for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // 1024) and all(r.length == 1024 for r in own[1:])
        at = 0
        for r in own:
            assert (r.start, r.ids_crc32) == (at, crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    assert not pieces
    for own in sequences.values():
        ends = [a + n for a, n in sorted(own)]
        assert [a for a, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(sequences) <= 1.03 * total / 1024 + 2


def test_op3_reads_back_every_document(spark, sf_dir, docs):
    found = sorted(map(tuple, queries.op3_token_files(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    want, start = [], 0
    for doc_id, text in docs:
        ids = plain_ids(WORDS, text, 1)
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert found == want


def test_op3_sends_ids_to_no_second_worker(spark, sf_dir):
    """The files' own reader is the only Python worker of the last stage."""
    plan = queries.op3_token_files(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_op4_scores_every_document(spark, sf_dir, docs):
    found = {r.doc_id: r for r in queries.op4_lm_score(spark, sf_dir).collect()}
    assert {i: r.n_tokens for i, r in found.items()} == {i: len(plain_ids(BYTES, text, 2)) for i, text in docs}
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    by = [[r.score for i, r in found.items() if (i in good) == side] for side in (True, False)]
    assert np.mean(by[0]) < np.mean(by[1])


def test_op5_digests_are_those_of_the_table(spark, sf_dir):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    marked = r"\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", marked), (1, "assistant", marked)]
    found = {r.conv_id: r for r in queries.op5_chat_format(spark, sf_dir).collect()}
    assert set(found) == set(turns)
    for conv_id, own in turns.items():
        own.sort(key=lambda t: t[0])
        learned = "".join(text for _, role, text in own if role == "assistant")
        r = found[conv_id]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_op6_links_what_is_close(spark, sf_dir, docs):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash(spark, sf_dir).collect()}
    prints = {doc_id: plain_fingerprint(text) for doc_id, text in docs}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    root = plain_components(prints, linked)
    assert linked and found == {i: (f"{p:016x}", root[i]) for i, p in prints.items()}


@pytest.fixture(scope="module")
def vectors(spark, sf_dir, tmp_path_factory):
    """The given vectors, with copies, near ones and unsound ones among them, under ids of their own."""
    rng = np.random.default_rng(2)
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    for i in range(120):
        v = np.array(rows[i % 15][1], np.float64)
        rows.append((1000 + i, (v + rng.normal(0, (0.02 + 0.003 * i) * np.abs(v).mean(), len(v))).astype(np.float32).tolist(), i))
    rows += [(2000, None, 0), (2020, [float("nan")] * 64, 1), (2040, [0.0] * 64, 2), (2060, [float("inf")] + [1.0] * 63, 3), (2080, rows[3][1], 4)]
    folder = str(tmp_path_factory.mktemp("vectors"))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder, rows


def test_op7_links_are_those_of_brute_force(spark, vectors):
    folder, rows = vectors
    sound = {i: np.array(v, np.float64) for i, v, _ in rows if v and np.isfinite(v).all() and np.any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in sound.items()}
    linked = [(a, b) for a in unit for b in unit if a < b and unit[a] @ unit[b] >= 0.95]
    root = plain_components([i for i, *_ in rows], linked)
    links = defaultdict(int)
    for a, b in linked:
        links[a] += 1
        links[b] += 1
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op7_multi_index(spark, folder).collect()}
    assert len(linked) > 100 and found == {i: (links[i], root[i], root[i] == i) for i, *_ in rows}


def test_op10_ranks_are_those_of_brute_force(spark, vectors):
    folder, rows = vectors
    whole = {i: np.floor(64 * np.array(v, np.float64)).astype(int) for i, v, _ in rows if v and np.isfinite(v).all()}
    want = set()
    for q in (i for i in whole if i % 20 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:20]
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    found = queries.op10_top_k(spark, folder)
    assert dict(found.dtypes)["rank"] == "int" and set(map(tuple, found.collect())) == want


def test_op8_and_op9_learn_from_other_rows_than_they_are_held_against(spark, sf_dir):
    texts = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    votes = queries.op8_quality_votes(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in votes) == sorted(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in votes)
    right = [r.predicted == labels[r.doc_id] for r in votes if r.held_out and labels.get(r.doc_id) is not None]
    assert len(right) > 5 and np.mean(right) > 0.9
    spoken = queries.op9_language_crf(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in spoken) == sorted(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in spoken)
    right = [r.lang_pred == texts[r.doc_id].lang for r in spoken if r.held_out and r.lang_pred != "und" and texts[r.doc_id].lang]
    assert np.mean(right) > 0.95


def test_a_session_without_a_shared_folder_is_left_as_it_is(spark):
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=spark.sparkContext)
    folder = scratch.shared_folder(bare)
    assert folder == scratch.shared_folder(bare) and os.path.isdir(folder)
    elsewhere = SimpleNamespace(conf=bare.conf, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(elsewhere)
