from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tapwise.llm import language, quality, queries

from llm_rows import odd_rows
from test_operators import BYTES, plain_components, plain_fingerprint, plain_ids


def through(spark, docs, sf_dir, folder):
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf_dir)
        found.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept.append(docs)
    return kept


@pytest.mark.parametrize("table", ["odd", "clashing", "nothing"])
def test_odd_rows_go_through(spark, request, table, labels_dir, tmp_path):
    docs = request.getfixturevalue(table)
    kept = through(spark, docs, labels_dir, str(tmp_path))
    assert all(stage.columns == docs.columns for stage in kept[:-1])
    spoken = kept[0].select("text").collect()
    assert all(any(c.isalpha() for c in r.text) for r in spoken)
    if table == "nothing":
        assert kept[-1].count() == 0
        return
    # What each stage keeps is what its operator says, on its own input.
    once = kept[2].groupBy("doc_id").count().where("count > 1 and doc_id is not null").count()
    assert once == 0
    words = F.size(F.split(F.trim("text"), r"\s+"))
    before, after = (stage.agg(F.sum(words)).first()[0] for stage in kept[2:4])
    assert abs(after - before) <= 200
    ends = kept[4].groupBy("sequence_id").agg(F.max(F.col("offset") + F.col("length")).alias("end"), F.sum("length").alias("sum"))
    assert ends.where("end <> sum or end > 1024").count() == 0


def test_clean_documents_stay(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    known = corpus_pipeline.keep_known_language(spark, docs, sf_dir)
    assert known.count() >= 0.99 * docs.count()
    clean = docs.join(good, "doc_id", "left_semi")
    kept = corpus_pipeline.keep_good_quality(spark, docs, sf_dir).join(good, "doc_id", "left_semi")
    assert kept.count() >= 0.98 * clean.count()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0


def test_run_keeps_what_plain_versions_keep(spark, odd, labels_dir, monkeypatch):
    odd.write.parquet(f"{labels_dir}/documents.parquet")
    labels = spark.read.parquet(f"{labels_dir}/labels.parquet")
    inputs = []

    def noted(stage):
        def step(spark, docs, sf_dir):
            inputs.append(docs)
            return stage(spark, docs, sf_dir)

        return step

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, noted(stage)) for name, stage in corpus_pipeline.STAGES])
    packed = corpus_pipeline.run(spark, labels_dir).collect()
    assert len(inputs) == 5
    rows = [Counter(tuple(r) for r in docs.collect()) for docs in inputs]
    assert rows[0] == Counter(odd_rows())
    field, space = language.learn(inputs[0]), quality.learn(inputs[1], labels)

    def spoken(text):
        found, score = language.text_languages([text], field)[0]
        return found != "und" and score >= 0.5

    assert rows[1] == Counter({r: n for r, n in rows[0].items() if spoken(r[1])})
    assert rows[2] == Counter({r: n for r, n in rows[1].items() if space.score(quality.term_counts(r[1])[None])[0] >= 0.3})
    values = [plain_fingerprint(r[1]) for r in rows[2]]
    root = plain_components(values, [(a, b) for a in values for b in values if (a ^ b).bit_count() <= 4])
    groups = {}
    for r in rows[2]:
        groups.setdefault(root[plain_fingerprint(r[1])], []).append(r)
    least = [min((r[0] is None, r[0] or 0) for r in own) for own in groups.values()]
    assert Counter((r[0] is None, r[0] or 0) for r in rows[3].elements()) == Counter(least)
    assert not set(rows[3]) - set(rows[2])
    texts = {(r[0], r[3]): r[1].split() for r in rows[3]}
    assert all(Counter(r[1].split()) <= Counter(texts[r[0], r[3]]) for r in rows[4])
    wanted = Counter()
    for r in rows[4].elements():
        wanted[r[0]] += len(plain_ids(BYTES, r[1], 2))
    found = Counter()
    for r in packed:
        found[r.doc_id] += r.length
    assert found == wanted
