import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import llm.brute as brute
from tollbook.llm import queries, quality_model, quality_rules
from tollbook.llm.common import stored

FOLDER = "/root/testdata/sf0.001"


def by_id(rows, column):
    return {r.doc_id: r[column] for r in rows.collect()}


def test_every_stage_works_on_what_the_one_before_kept(spark):
    """Each against its definition, on its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "quality classifier", "n-gram Jaccard join", "substring dedup", "packing"]
    outputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outputs.append(stored(stage(spark, outputs[-1], FOLDER), name.replace(" ", "-")))
    assert all(o.columns == docs.columns and o.dtypes == docs.dtypes for o in outputs[:-1])
    texts = [by_id(o, "text") for o in outputs[:-1]]
    judged = quality_rules.judge(docs, "doc_id").filter("kept")
    assert set(texts[1]) == set(by_id(judged, "kept"))
    model = quality_model.train(outputs[1], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert set(texts[2]) == set(by_id(quality_model.score(outputs[1], model).filter("kept"), "kept"))
    ids = sorted(texts[2])
    _, components = brute.near_duplicates([texts[2][k] for k in ids])
    assert set(texts[3]) == {ids[c] for c in components}
    ids = sorted(texts[3])
    for key, (_, gone, left) in zip(ids, brute.without_repeats([texts[3][k] for k in ids])):
        assert texts[4][key] == (left if gone else texts[3][key])
    assert by_id(outputs[4], "n_chars") == {k: len(t) for k, t in texts[4].items()}
    assert {r.doc_id for r in outputs[5].select("doc_id").distinct().collect()} == set(ids)
    # Nothing changes without a reason.
    assert all(texts[3][k] == texts[0][k] for k in texts[3])


def test_stages_with_awkward_documents(spark, documents):
    good = [brute.prose(brute.rng(k), 120) for k in range(30)]
    rows = [*enumerate(good), (None, good[0]), (3, good[3]), (40, None), (41, "")]
    docs = documents(*rows)
    folder = FOLDER
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        assert stage(spark, documents(), folder).count() == 0, name
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, folder)
    assert sorted(r.text or "" for r in kept.collect()) == sorted([*good, "", ""])
    assert corpus_pipeline.substring_stage(spark, docs, folder).filter("doc_id = 40").first().text is None


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op8_ngram_join"])
def test_queries_over_the_whole_table(spark, name):
    docs = sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").collect(), key=lambda r: r.doc_id)
    rows = sorted(queries.QUERIES[name](spark, FOLDER).collect(), key=lambda r: r.doc_id)
    texts = [d.text for d in docs]
    if name.startswith("op2"):
        expected = [(n, gone, hashlib.sha256(t.encode()).hexdigest()) for n, gone, t in brute.without_repeats(texts)]
        assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == expected
    else:
        sizes, components = brute.near_duplicates(texts)
        assert [(r.n_shingles, r.component_id) for r in rows] == [(n, docs[c].doc_id) for n, c in zip(sizes, components)]


def test_vectors_over_the_whole_table(spark):
    table = sorted(spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    rows = sorted(queries.op10_vector_join(spark, FOLDER).collect(), key=lambda r: r.vec_id)
    links, components = brute.near_vectors([r.embedding for r in table])
    assert [(r.n_links, r.component_id) for r in rows] == [(n, table[c].vec_id) for n, c in zip(links, components)]


def test_base_counts_over_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in queries.op4_quality_rules(spark, FOLDER).collect():
        words, chars, symbols, lines, repeats = brute.base(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (words, chars, symbols, lines, repeats)
        assert r.base_failed == (words < 10 or 100 * repeats > 20 * words) and not (r.kept and r.base_failed)


def test_run_applies_all_stages(spark):
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert pieces.agg(F.sum("length")).first()[0] > 0
