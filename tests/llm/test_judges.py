import math

import numpy as np
from pyspark.sql import functions as F

import llm.brute as brute
from tollbook.llm import quality_model, quality_rules
from tollbook.llm.common import SPACES

FOLDER = "/root/testdata/sf0.01"


def awkward():
    rng = brute.rng(1)
    yield from (None, "", "   ", "\n\t\x0b", "one", "a b c d e a b c d e", "x\ny\nx\n\n\nx", "é 😀 #*$ %&|<>", "\xa0 　")
    yield from ("a a a a a a a a a", "lone\rcarriage\x0creturns here now", brute.prose(rng, 30_000, 3))
    for _ in range(40):
        yield brute.prose(rng, rng.randrange(60), rng.choice([2, 5, 400])).replace(" ", rng.choice([" ", "  ", "\n"]))


def test_counts_equal_their_definition(documents):
    texts = list(awkward())
    rows = quality_rules.measured(documents(*enumerate(texts)), "doc_id").collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    assert got == {k: brute.base(t) for k, t in enumerate(texts)}


def test_no_python_runs_on_executors(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = quality_rules.measured(docs, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_verdicts_on_null_repeated_and_no_rows(documents):
    good = brute.prose(brute.rng(2), 80)
    rows = quality_rules.judge(documents((1, good), (1, good), (None, good), (2, None), (3, "few words")), "doc_id")
    got = sorted((str(r.doc_id), r.base_failed, r.kept) for r in rows.collect())
    assert got == [("1", False, True)] * 2 + [("2", True, False), ("3", True, False), ("None", False, True)]
    assert quality_rules.judge(documents(), "doc_id").count() == 0


def expected_trust(patterns, names, rounds=12):
    """The estimate, step by step in Python."""
    good_share, on_good, on_bad = quality_rules.GOOD, {}, {}
    on_good = dict.fromkeys(names, quality_rules.ACCUSES_GOOD)
    on_bad = dict.fromkeys(names, quality_rules.ACCUSES_BAD)

    def posterior(votes):
        good, bad = good_share, 1 - good_share
        for name, vote in zip(names, votes):
            if vote:
                good *= on_good[name] if vote < 0 else 1 - on_good[name]
                bad *= on_bad[name] if vote < 0 else 1 - on_bad[name]
        return good / (good + bad)

    total = sum(patterns.values())
    for _ in range(rounds):
        p = {votes: posterior(votes) for votes in patterns}
        held, new_good, new_bad = quality_rules.BELIEF * total, {}, {}
        for k, name in enumerate(names):
            g = {v: sum(n * p[x] for x, n in patterns.items() if x[k] == v) for v in (-1, 1)}
            b = {v: sum(n * (1 - p[x]) for x, n in patterns.items() if x[k] == v) for v in (-1, 1)}
            good = (g[-1] + held * quality_rules.ACCUSES_GOOD) / (g[-1] + g[1] + held)
            bad = (b[-1] + held * quality_rules.ACCUSES_BAD) / (b[-1] + b[1] + held)
            good = min(good, quality_rules.ACCUSES_GOOD)
            bad = min(bad, 1 - (1 - good) / quality_rules.CONTENT)
            new_good[name], new_bad[name] = (
                (good, bad) if bad > good else (quality_rules.ACCUSES_GOOD, quality_rules.ACCUSES_BAD)
            )
        good_share = min(0.99, max(0.5, sum(n * p[x] for x, n in patterns.items()) / total))
        on_good, on_bad = new_good, new_bad
    return good_share, on_good, on_bad, posterior


def test_estimate_equals_its_definition(spark):
    names = ["a", "b", "c"]
    patterns = {(1, 1, 1): 800, (1, 1, 0): 90, (-1, 1, 1): 40, (1, -1, -1): 50, (0, 0, 0): 5, (-1, -1, 1): 15}
    frame = spark.createDataFrame([(*v, n) for v, n in patterns.items()], "a int, b int, c int, n long")
    trust = quality_rules.estimate(frame, names)
    share, on_good, on_bad, posterior = expected_trust(patterns, names)
    assert math.isclose(trust.good, share, rel_tol=1e-9)
    for name in names:
        assert math.isclose(trust.on_good[name], on_good[name], rel_tol=1e-9)
        assert math.isclose(trust.on_bad[name], on_bad[name], rel_tol=1e-9)
        assert 0 < trust.accuracy(name) < 1
    for r in frame.withColumn("p", trust.posterior()).collect():
        assert math.isclose(r.p, posterior((r.a, r.b, r.c)), rel_tol=1e-9)
    # One accusation by any rule outweighs the others' content.
    assert posterior((-1, 1, 1)) < 0.5 < posterior((1, 1, 1))


def test_rules_against_the_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    judged = quality_rules.judge(docs, "doc_id").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    judged = judged.filter("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in judged.collect()}
    assert kept[1] > 0.99 and kept.get(0, 0) < 0.1


def test_agreement_finds_who_is_right():
    rng = np.random.default_rng(3)
    bad = rng.random(20_000) < 0.2
    votes = np.stack([np.where(rng.random(20_000) < np.where(bad, hit, 0.0005), 1, -1) for hit in (0.7, 0.5, 0.3)], 1)
    patterns, which, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, accuracy = quality_model.agreement(patterns, n.astype(float))
    accused = (votes == 1).any(axis=1)
    assert ((posterior[which.ravel()] > 0.5) == accused).all()
    assert accuracy[0] >= accuracy[2] - 1e-9


def test_the_scorer_on_held_out_labels(spark):
    """Fitted without one half of the labels, judged on that half."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen, unseen = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    model = quality_model.train(docs, seen)
    rows = quality_model.score(docs, model).drop("quality").join(unseen, "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1 and not r.toxic]
    form = [r.kept for r in rows if r.quality == 0]
    toxic = [r.kept for r in rows if r.toxic]
    assert np.mean(clean) > 0.93 and np.mean(form) < 0.05 and np.mean(toxic) < 0.25


def test_scores_of_awkward_texts(spark, documents):
    good = brute.prose(brute.rng(4), 120)
    docs = documents(*[(k, brute.prose(brute.rng(k), 120)) for k in range(60)], (None, good), (1, good), (70, None), (71, ""))
    model = quality_model.train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = quality_model.score(docs, model).collect()
    assert len(rows) == 64 and all(0 <= r.quality <= 1 and 0 <= r.abuse <= 1 for r in rows)
    assert {r.n_words for r in rows if r.doc_id in (70, 71)} == {0}
    empty = quality_model.train(documents(), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert quality_model.score(documents(), empty).count() == 0


def test_training_is_repeatable(spark, documents):
    """Repeated numbers, labels that disagree and near copies, in any order."""
    rng = brute.rng(9)
    texts = [brute.prose(rng, 60) + (" awful nasty" if k % 4 == 0 else "") for k in range(120)]
    rows = [(k % 90, t) for k, t in enumerate(texts)] + [(k % 50, t + " more") for k, t in enumerate(texts[:60])]
    marks = [(k, 1, int(k % 4 == 0)) for k in range(90)] + [(k, 0, 1 - int(k % 4 == 0)) for k in range(0, 90, 7)]
    models = []
    for turn in range(2):
        labels = spark.createDataFrame(marks[::-1] if turn else marks, "doc_id long, quality int, toxic int")
        docs = documents(*(rows[::-1] if turn else rows)).repartition(3 + turn)
        models.append(quality_model.train(docs, labels.repartition(1 + turn)))
    one, two = models
    assert (one.form == two.form).all() and (one.abuse == two.abuse).all()
    assert one.accuracy == two.accuracy and (one.form_bias, one.abuse_bias) == (two.form_bias, two.abuse_bias)


def test_spaces_are_the_six():
    assert sorted(SPACES) == sorted(chr(c) for c in (0x20, *range(0x09, 0x0E)))
