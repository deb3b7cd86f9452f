"""Learned operators: held-out accuracy and what scores must tell apart; the pipeline against its parts."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import common, lm_scoring, packing, quality

WORDS = [a + b for a in ("ka", "to", "mi", "ren", "sol", "vi") for b in ("la", "do", "ne", "ri", "sum")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        bad = i % 4 == 0
        t = text(rng, rng.randint(5, 60))
        rows.append((i, " ".join(w + "###" for w in t.split()) if bad else t, 0 if bad else 1))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_quality_on_the_held_out_fold(spark, labelled):
    more = spark.createDataFrame([(1000, None), (1001, ""), (1002, "word " * 30_000), (1003, "x")], "doc_id long, text string")
    docs = labelled.drop("quality").unionByName(more).withColumn("quality", F.lit("clash")).withColumn("score", F.lit(9))
    got = quality.quality_scores(docs, labelled.select("doc_id", "quality")).collect()
    assert len(got) == 304 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    truth = {r["doc_id"]: r["quality"] for r in labelled.collect()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert 30 < len(held) < 90 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    again = quality.quality_scores(docs, labelled.select("doc_id", "quality")).collect()
    assert {r["doc_id"]: r["score"] for r in got} == {r["doc_id"]: r["score"] for r in again}


def test_quality_fits_one_row_for_each_label(spark, labelled, monkeypatch):
    docs = labelled.select("doc_id", "text").unionByName(spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("copy "), F.col("id").cast("string")).alias("text")))
    seen = []
    monkeypatch.setattr(quality, "Network", lambda x, y: seen.append(x.shape[0]))
    quality.fit(docs, labelled.select("doc_id", "quality"))
    quality.fit(docs, labelled.select("doc_id", "quality"), rows=40)
    assert 200 < seen[0] < 280 and seen[1] == 40


def test_quality_without_labels(spark, labelled):
    none = labelled.select("doc_id", "quality").limit(0)
    assert {r["score"] for r in quality.quality_scores(labelled.limit(3), none).collect()} == {0.5}
    assert quality.quality_scores(labelled.limit(0), none).count() == 0


def test_lm_prefers_the_order_that_it_learned(spark):
    rng = random.Random(1)
    pairs = dict(zip(WORDS[::2], WORDS[1::2]))
    rows = [(i, " ".join(f"{a} {pairs[a]}" for a in rng.choices(list(pairs), k=60))) for i in range(150)]
    docs = spark.createDataFrame(rows + [(1000, None), (1001, ""), (1002, "unseen " * 20_000)], "doc_id long, text string").withColumn("n", F.lit("clash"))
    words, sizes = lm_scoring.vocabulary(docs)
    params = lm_scoring.fit(lm_scoring.encoded(docs, words), sizes)
    turned = [(i, " ".join(rng.sample(t.split(), len(t.split())))) for i, t in rows[:40]]
    score = lambda df: {r["doc_id"]: r for r in lm_scoring.scores(lm_scoring.encoded(df, words), params).collect()}
    good, bad = score(docs), score(spark.createDataFrame(turned, "doc_id long, text string"))
    assert np.mean([good[i]["log_likelihood"] > bad[i]["log_likelihood"] for i, _ in turned]) > 0.95
    assert (good[1000]["n_tokens"], good[1000]["log_likelihood"], good[1000]["mean_log_likelihood"]) == (0, 0.0, None) == (good[1001]["n_tokens"], good[1001]["log_likelihood"], good[1001]["mean_log_likelihood"])
    assert lm_scoring.score_documents(docs.limit(0)).count() == 0


def test_lm_tells_words_of_a_class_apart(spark):
    rng = random.Random(5)
    many = [f"w{i}" for i in range(lm_scoring.FREQUENT)]
    rare = [f"r{i}" for i in range(300)]
    rows = [(i, " ".join(many + rng.choices(rare, range(1, 301), k=20))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = collections.Counter(w for _, t in rows for w in t.split())
    words, sizes = lm_scoring.vocabulary(docs)
    tokens = lm_scoring.encoded(docs, words)
    alone = {r["doc_id"]: r for r in lm_scoring.scores(tokens, lm_scoring.fit(tokens, sizes)).collect()}
    of = lm_scoring.Classes(words).of
    whole = lm_scoring.score_documents(docs).collect()
    assert len(whole) == 30
    for r in whole:
        shared = [w for w in rows[r["doc_id"]][1].split() if w not in words]
        want = sum(np.log(counts[w] / sizes[of(w)[0]]) for w in shared)
        assert len(shared) >= 10 and abs(r["log_likelihood"] - alone[r["doc_id"]]["log_likelihood"] - want) < 1e-2
        assert abs(r["mean_log_likelihood"] * r["n_tokens"] - r["log_likelihood"]) < 1e-6
    assert lm_scoring.score_documents(docs.select("doc_id", F.lit("one two three").alias("text"))).where("mean_log_likelihood < 0").count() == 30  # empty classes


def test_lm_learns_from_every_token_once(spark, monkeypatch, tmp_path):
    seen, train = str(tmp_path / "seen"), lm_scoring.train

    def watched(p, memory, flat, at, rate):
        with open(seen, "a") as f:
            f.write("".join(f"{flat[a]}\n" for a in at))
        train(p, memory, flat, at, rate)

    monkeypatch.setattr(lm_scoring, "train", watched)
    docs = spark.createDataFrame([(i, " ".join(WORDS[: 3 + i])) for i in range(20)], "doc_id long, text string")
    words, sizes = lm_scoring.vocabulary(docs)
    lm_scoring.fit(lm_scoring.encoded(docs, words), sizes)
    got = collections.Counter(map(int, open(seen).read().split()))
    assert got == {i: int(n) for i, n in enumerate(sizes) if n}


def test_lm_probabilities_sum_to_one():
    p = lm_scoring.initial(np.arange(lm_scoring.CLASSES, dtype=float))
    flat, at = lm_scoring.padded([np.array([1, 2, 3])])
    assert np.exp(lm_scoring.log_probabilities(p, flat, at)).max() < 1
    total = 0.0
    for c in range(lm_scoring.CLASSES):  # each class in the place of the second token
        flat[at[1]] = c
        total += np.exp(lm_scoring.log_probabilities(p, flat, at[1:2]))
    assert np.allclose(total, 1, atol=1e-4)


def test_lm_steps_go_down_the_gradient():
    rng = np.random.default_rng(3)
    p = [x + rng.normal(0, 0.1, x.shape).astype(np.float32) for x in lm_scoring.initial(np.ones(lm_scoring.CLASSES))]
    flat, at = lm_scoring.padded([rng.integers(0, lm_scoring.CLASSES, 50).astype(np.int16) for _ in range(4)])
    loss = lambda q: -lm_scoring.log_probabilities([x.astype(float) for x in q], flat, at).mean()
    moved, memory = [x.copy() for x in p], [np.full_like(x, 1e12) for x in p]  # with such a past a step is the gradient / 1e6
    lm_scoring.train(moved, memory, flat, at, 1e6)
    for k in range(len(p)):
        gradient = p[k] - moved[k]
        spots = rng.permutation(np.flatnonzero(gradient))[:5]
        for i in spots:
            up, down = [x.astype(float) for x in p], [x.astype(float) for x in p]
            up[k].ravel()[i] += 1e-4
            down[k].ravel()[i] -= 1e-4
            assert abs((loss(up) - loss(down)) / 2e-4 - gradient.ravel()[i]) < 2e-4 + 0.05 * abs(gradient.ravel()[i])


def test_lm_scores_do_not_depend_on_partitions_and_gain_on_word_counts(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(w for _ in range(40) for w in (lambda k: (WORDS[k], WORDS[(k * 7 + 3) % 30]))(rng.randrange(30)))) for i in range(120)]
    rows += [(5, "two rows of one id"), (5, "two rows of one id"), (None, "no id at all")]
    one = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted(map(tuple, lm_scoring.score_documents(df).fillna(-1, "doc_id").collect())) for df in (one.coalesce(1), one.repartition(7))]
    assert len(got[0]) == len(rows) and [x[:2] for x in got[0]] == [x[:2] for x in got[1]]
    assert np.allclose([x[2] for x in got[0]], [x[2] for x in got[1]], rtol=1e-6)  # sums of 32-bit floats
    counts = collections.Counter(w for _, t in rows for w in t.split())
    total = sum(counts.values())
    unigram = sum(n * np.log(n / total) for n in counts.values()) / total
    assert sum(x[2] for x in got[0]) / total > unigram + 0.5


def test_pipeline_keeps_and_drops(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(4)
    clean = {i: text(rng, 80) for i in range(60)}
    docs = dict(clean)
    docs[100], docs[101] = clean[3], clean[4] + " more"  # exact and near copies
    docs[102] = text(rng, 20) + " " + clean[5] + " " + text(rng, 20)  # a long repeated passage
    item = text(rng, 30)
    docs[103] = text(rng, 30) + " " + item  # a benchmark passage
    for i in range(200, 230):
        docs[i] = " ".join(w + "###" for w in text(rng, 40).split())
    docs[300] = None
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i < 200), 0) for i in docs], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, at = {}, common.documents(spark, str(tmp_path))
    for name, stage in pipeline.STAGES:
        at = common.materialise(stage(spark, at, str(tmp_path)), "test")
        kept[name] = {r["doc_id"] for r in at.select("doc_id").collect()}
        if name != "packing":
            assert at.columns == list(pipeline.COLUMNS)
    assert set(clean) <= kept["quality"] and not kept["quality"] & set(range(200, 230))
    assert kept["near_dedup"] == kept["quality"] - {100, 101}
    assert kept["suffix_dedup"] == kept["near_dedup"]
    assert kept["decontaminate"] == kept["suffix_dedup"] - {103}
    assert kept["packing"] == kept["decontaminate"]
    want = sorted(map(tuple, at.collect()))
    assert sorted(map(tuple, pipeline.run(spark, str(tmp_path)).collect())) == want
    passage = {r["doc_id"]: r["text"] for r in pipeline.suffix_dedup_stage(spark, common.documents(spark, str(tmp_path)), str(tmp_path)).collect()}[102]
    assert clean[5][50:-50] not in passage and len(passage) > 100
    assert packing.CAPACITY == 1024
