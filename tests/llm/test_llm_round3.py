"""Collocations, vector codes and quality rules against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import collocations, quality_rules, vector_codes

CLASH = ("lang2", "size", "phrase", "f", "a", "k", "rank")


def plain_collocations(rows, most=5, least=100, top=2000):
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for s in range(1, most + 1):
                for i in range(len(w) - s + 1):
                    f[lang, tuple(w[i : i + s])] += 1
    candidates = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    inside = {(lang, p[i:j]) for (lang, p), a in candidates.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1) if j - i < len(p) and f[lang, p[i:j]] <= a}
    out = collections.defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) in inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, v in out.items() for i, (s, a, p, x, y) in enumerate(sorted(v)[:top]))


def collocation_rows(seed, count, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Ä", "ä", "é", "THE", "the", "a b", "\x00"]
    fixed = ["of the new york times", "machine learning", "a a a a a"]
    rows = [(rng.choice(["en", "de", "und", None]), rng.choice(" \t").join(rng.choice(vocabulary + fixed) + rng.choice(["", "", ",", ".", "\n", ";x", " \t"]) for _ in range(rng.randint(0, 60)))) for _ in range(count)]
    return rows + [("en", None), ("fr", ""), (None, None), ("en", " \t\n.,"), ("en", rows[0][1])]


@pytest.mark.parametrize("least,top,chunk", [(3, 2000, 8 << 20), (5, 7, 500)])
def test_collocations_against_plain_counts(spark, monkeypatch, least, top, chunk):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    rows = collocation_rows(3, 150)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    got = sorted(map(tuple, collocations.collocations(df, 5, least, top).collect()))
    assert got == plain_collocations(rows, 5, least, top) and len(got) > 10


def test_collocations_do_not_depend_on_the_filter(spark, monkeypatch):
    rows = collocation_rows(4, 120)
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 15)
    whole = sorted(map(tuple, collocations.collocations(df, 4, 4, 50).collect()))
    full = spark.sparkContext.broadcast(b"\xff" * 4096)
    monkeypatch.setattr(collocations, "_bits", lambda *_: full)  # an array that lets everything pass
    assert whole == sorted(map(tuple, collocations.collocations(df, 4, 4, 50).collect())) == plain_collocations(rows, 4, 4, 50)


def test_collocations_of_nothing_and_of_a_long_text(spark):
    none = spark.createDataFrame([(None, None), ("en", ""), ("en", "one two")], "lang string, text string")
    assert collocations.collocations(none).collect() == [] == collocations.collocations(none.limit(0)).collect()
    long = [("en", "new york " * 200_000)]
    got = [tuple(r) for r in collocations.collocations(spark.createDataFrame(long, "lang string, text string"), least=100_000).collect()]
    assert got == plain_collocations(long, least=100_000) and got


def plain_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    kept = sorted((r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])), key=lambda r: (r[0] is None, r[0], r[2]))
    if not kept:
        return []
    size = len(kept[0][2])
    kept = [r for r in kept if len(r[2]) == size]
    width = -(-size // parts)
    whole = [([math.floor(scale * x) for x in r[2]] + [0] * (parts * width - size)) for r in kept]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[cut[i][p] for i in range(min(entries, len(kept)))] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            mine = collections.defaultdict(list)
            for v in cut:
                mine[near(v[p], books[p])[1]].append(v[p])
            books[p] = [tuple(sum(c) // len(mine[k]) for c in zip(*mine[k])) if mine[k] else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by = [], collections.Counter()
    for r, v in zip(kept, cut):
        found = [near(v[p], books[p]) for p in range(parts)]
        out.append((r[0], r[1], "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        by[r[1]] += out[-1][3]
    return [(i, c, e, by[lab], digest) for i, lab, c, e in out]


def vectors(seed, n, size=20):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(9)]
    rows = [(i * 3 % n, rng.choice([0, 1, 1, None]), [float(np.float32(c + rng.gauss(0, 0.2))) for c in rng.choice(centres)]) for i in range(n)]
    same = [(n + i, 7, rows[5][2]) for i in range(40)]
    odd = [(n + 100, 1, None), (n + 101, 1, [None] * size), (n + 102, 1, [float("nan")] * size), (n + 103, 1, [float("inf")] + [0.0] * (size - 1)), (n + 104, 1, []), (None, None, rows[3][2]), rows[0]]
    return rows + same + odd


@pytest.mark.parametrize("n,size,block", [(400, 20, 4096), (400, 16, 7), (9, 8, 4096), (30, 3, 5)])
def test_vector_codes_against_plain_lloyd(spark, monkeypatch, n, size, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rows = vectors(n + size, n, size)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3).withColumn("code", F.lit("clash")).withColumn("ids", F.lit(1))
    got = vector_codes.label_errors(vector_codes.compressed(df)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, got), key=key) == sorted(plain_codes(rows), key=key) and got


def test_vector_codes_of_nothing(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(1, 1, None), (2, 2, [float("nan")])]):
        assert vector_codes.label_errors(vector_codes.compressed(spark.createDataFrame(rows, schema))).collect() == []
    got = vector_codes.label_errors(vector_codes.compressed(spark.createDataFrame([(1, None, []), (2, 3, [])], schema))).collect()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    with pytest.raises(Exception, match="too large"):
        vector_codes.compressed(spark.createDataFrame([(1, 1, [1e30] * 8)], schema))


def test_heaps_leave_what_cannot_have_changed(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(-50_000, 50_000, (16, 8, 4))
    data = centres[rng.integers(0, 16, 3000)] + rng.integers(-400, 400, (3000, 8, 4))
    books, heaps = vector_codes.Codebooks(np.ascontiguousarray(centres.transpose(1, 0, 2))), vector_codes.Heaps(16)
    total = vector_codes.advance(data, heaps, books, True)
    compared = []
    count = vector_codes.distances
    vector_codes.distances = lambda part, entries: compared.append(len(part)) or count(part, entries)
    try:
        for _ in range(4):
            books = books.moved(total[..., :-1], total[..., -1])
            heaps = vector_codes.Heaps(16, heaps.state())
            total = total + vector_codes.advance(data, heaps, books, False)
    finally:
        vector_codes.distances = count
    assert sum(compared) < 0.05 * 4 * data.shape[0] * 8  # clusters far apart: hardly any part is compared again
    near = np.stack([count(data[:, p], books.entries[p]).argmin(1) for p in range(8)], 1)
    assert (heaps.codes(len(data)) == near).all()


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def judged_rows(seed, n=400):
    rng = random.Random(seed)
    words = [a + b for a in ("ka", "to", "mi", "ré", "sol") for b in ("la", "do", "ne", "ri", "日本")]
    rows = []
    for i in range(n):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", ". ", " ", "\t"]) for _ in range(rng.randint(30, 200)))
        bad = i % 3 == 0
        rows.append((i, re.sub(r"(\w) ", lambda m: m[1] + rng.choice("#&*$|") + " ", t) if bad else t, 0 if bad else 1))
    return rows


def test_quality_rules_base_and_verdict(spark):
    rows = judged_rows(1)
    odd = [(1000, None), (1001, ""), (1002, " \t\n\r\x0b\x0c"), (1003, "word " * 100_000), (1004, "a b c a b c\na b c a b c\n\n x"), (None, rows[1][1]), (5, rows[5][1]), (1005, "## " * 60), (1006, "x y \x85 z")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + odd, "doc_id long, text string").withColumn("quality", F.lit(9)).withColumn("kept", F.lit("clash")).repartition(3)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(2000, 1, 0), (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality_rules.quality_rules(docs, labels).collect()
    texts = collections.defaultdict(list)
    for i, t in [(i, t) for i, t, _ in rows] + odd:
        texts[i].append(t)
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert any(plain_statistics(t) == tuple(r[c] for c in quality_rules.BASE) for t in texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.THRESHOLD) and 0 <= r["score"] <= 1
    truth = {i: q for i, _, q in rows}
    held = [r for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and not r["base_failed"]]
    assert len(held) > 40 and np.mean([r["kept"] == (truth[r["doc_id"]] == 1) for r in held]) > 0.95


def test_quality_rules_without_labels_and_with_one_hot_id(spark):
    rows = judged_rows(2, 60)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["kept"] != r["base_failed"] and r["score"] == 1.0 for r in quality_rules.quality_rules(docs, none).collect())
    assert quality_rules.quality_rules(docs.limit(0), none).count() == 0
    hot = docs.unionByName(spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("copy "), F.col("id").cast("string")).alias("text")))
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    seen = []
    build, quality_rules.Trees = quality_rules.Trees, lambda x, y: seen.append(len(y)) or 0.5
    try:
        quality_rules.fit(hot, labels)
    finally:
        quality_rules.Trees = build
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in rows)]  # one row for each label


def test_trees_never_rise_with_a_falling_feature():
    rng = np.random.default_rng(5)
    x = rng.random((3000, len(quality_rules.FEATURES)))
    y = ((np.sin(9 * x[:, 2]) + x[:, 0] - x[:, 9] + 0.3 * rng.normal(size=3000)) > 0.4).astype(float)  # wavy in a falling feature
    trees = quality_rules.Trees(x, y)
    some = x[:200]
    for f in quality_rules.FALLING:
        at = quality_rules.FEATURES.index(f)
        scores = []
        for v in np.linspace(0, 1, 40):
            z = some.copy()
            z[:, at] = v
            scores.append(trees(z))
        assert (np.diff(np.array(scores), axis=0) <= 1e-12).all()
    free = quality_rules.FEATURES.index("digits")
    z = np.repeat(some[:1], 40, 0)
    z[:, free] = np.linspace(0, 1, 40)
    assert np.ptp(trees(z)) > 0.05
    fits = (x[:, 0] - x[:, 9] - x[:, 2] > -0.5).astype(float)  # a rule that the constraints allow
    assert np.mean((quality_rules.Trees(x[:2000], fits[:2000])(x[2000:]) > 0.5) == (fits[2000:] > 0)) > 0.85
    plain = np.array([trees.start + quality_rules.RATE * sum(_walk(trees, t, row) for t in range(quality_rules.TREES)) for row in some[:20]])
    assert np.allclose(1 / (1 + np.exp(-plain)), trees(some[:20]))


def _walk(trees, t, row):
    node = 0
    for level in range(quality_rules.DEPTH):
        k = (1 << level) - 1 + node
        node = 2 * node + int(row[trees.feature[t, k]] > trees.threshold[t, k])
    return trees.value[t, node]


def test_lm_scores_against_a_plain_pseudo_likelihood(spark):
    from quarry.llm import lm_scoring

    rng = random.Random(4)
    words = [f"w{i}" for i in range(1200)]  # more than have a class of their own
    rows = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(1200)], k=rng.randint(1, 80)))) for i in range(120)] + [(500, None), (501, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = lm_scoring.counted(docs)
    own, sizes, known = lm_scoring._vocabulary(counts, 1000)
    tokens = lm_scoring.encoded(docs, own, known)
    params = lm_scoring.fit(tokens, sizes)
    got = {r["doc_id"]: r for r in lm_scoring.scores(tokens, params, lm_scoring.word_terms(tokens, counts, sizes)).collect()}
    number, n = {w: i for i, w in enumerate(own)}, collections.Counter(w for _, t in rows for w in (t or "").split())
    e, b, a, c, inner, bias = (x.astype(float) for x in params)
    for i, t in rows[:12] + rows[-2:]:
        ws = (t or "").split()
        of = [number.get(w, lm_scoring.FREQUENT + zlib.crc32(w.encode()) % lm_scoring.SHARED) for w in ws]
        total = 0.0
        for k, (w, y) in enumerate(zip(ws, of)):
            h = b.copy()
            for j, off in enumerate(lm_scoring.OFFSETS):  # the token itself is masked: only its neighbours are read
                h = h + e[j][of[k + off] if 0 <= k + off < len(of) else lm_scoring.PAD]
            h = np.tanh(h)
            g, m = divmod(y, lm_scoring.GROUP)
            for z, at in ((h @ a + c, g), (h @ inner[g] + bias[g], m)):
                total += z[at] - z.max() - math.log(np.exp(z - z.max()).sum())
            total += 0.0 if w in number else math.log(n[w] / sizes[y])
        assert got[i]["n_tokens"] == len(ws) and abs(got[i]["log_likelihood"] - total) < 1e-3 * max(1, len(ws))


def test_lm_averages_in_levels(spark, monkeypatch):
    from quarry.llm import lm_scoring

    parts = [(b, b + 1, np.array([b, 1.0]).tobytes()) for b in range(100)]
    df = spark.createDataFrame(parts, "block long, n long, p binary").repartition(7)
    monkeypatch.setattr(lm_scoring, "PARTS", 4)
    got = lm_scoring.summed(df, 100).collect()
    assert len(got) <= 4 and sum(r["n"] for r in got) == 5050 and sum(np.frombuffer(r["p"]) for r in got).tolist() == [4950.0, 100.0]


def test_token_rows_against_plain_best_fit_decreasing():
    from quarry.llm import token_output

    rng = random.Random(11)
    for n in (0, 1, 40, 300):
        lengths = [rng.choice([rng.randint(1, 64), 64, 1, rng.randint(20, 40)]) for _ in range(n)]
        rooms = []
        for x in sorted(lengths, reverse=True):
            fits = [k for k, r in enumerate(rooms) if r >= x]
            if fits:
                rooms[min(fits, key=lambda k: rooms[k])] -= x
            else:
                rooms.append(64 - x)
        got = token_output.best_fit_decreasing(lengths, 64)
        assert sorted(i for row in got for i in row) == list(range(n)) and all(sum(lengths[i] for i in row) <= 64 for row in got)
        assert sorted(64 - sum(lengths[i] for i in row) for row in got) == sorted(rooms)  # as many rows, with the same room left
