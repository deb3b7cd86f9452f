"""Operators whose results are exact, against plain versions; nulls, empty, long and repeated rows, empty tables, extra columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import chat_format, decontaminate, fingerprints, license_scan, near_dedup, packing, suffix_dedup, token_output

DOCS = "doc_id long, text string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ly"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = prose(rng, 120)
    swapped = base.split()
    swapped[10], swapped[60] = "other", "words"
    shared = prose(rng, 40)
    return {
        1: base, 2: base, 3: " ".join(swapped), 4: prose(rng, 30) + " " + shared + " " + prose(rng, 20), 5: prose(rng, 10) + " " + shared, 6: None, 7: "", 8: "one", 9: "Ünïcode ÄÖ " * 40,
        10: "abcdefg" * 60, 11: prose(rng, 4000), 12: " \n\t ", 13: "one", 14: "a b c d", 15: "x" * 99, 16: "x" * 100, 17: "x" * 101,
    }


@pytest.fixture(scope="module")
def docs(spark, texts):
    extra = [(k, v, "clash", 5, "x") for k, v in texts.items()]
    return spark.createDataFrame(extra, "doc_id long, text string, gram string, first long, __d string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_suffix_dedup(docs, texts, empty):
    seen, want = set(), {}
    for d in sorted(texts):
        data = (texts[d] or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        left = bytes(b for b, g in zip(data, gone) if not g)
        want[d] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(docs).collect()}
    assert got == want
    assert suffix_dedup.digest(empty).count() == 0


def test_suffix_dedup_window_by_window(spark, docs, texts, monkeypatch):
    want = sorted(map(tuple, suffix_dedup.digest(docs).collect()))
    monkeypatch.setattr(suffix_dedup, "MANY_KINDS", 1)
    assert sorted(map(tuple, suffix_dedup.digest(docs).collect())) == want


def test_suffix_dedup_long_documents_in_blocks(spark, monkeypatch):
    rng = random.Random(1)
    a = prose(rng, 3000)
    df = spark.createDataFrame([(1, a), (2, "intro " + a[500:9000] + prose(rng, 50))], DOCS)
    want = sorted(map(tuple, suffix_dedup.digest(df).collect()))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    assert sorted(map(tuple, suffix_dedup.digest(df).collect())) == want


def test_kept_text_is_whole_characters(spark):
    rng = random.Random(7)
    s = "".join(rng.choice("äöüéèßñ漢") for _ in range(150))
    df = spark.createDataFrame([(1, "x" + s), (2, s + "end"), (3, None)], DOCS)
    got = {r["doc_id"]: r["kept_text"] for r in suffix_dedup.without_repeats(df).collect()}
    assert got[1] == "x" + s and got[2].endswith("end") and "�" not in got[2] and got[3] == ""


def test_multikey_quicksort():
    rng = np.random.default_rng(0)
    cols = [rng.integers(0, 5, 500), rng.integers(0, 3, 500), rng.integers(0, 1000, 500)]
    order = suffix_dedup.multikey_quicksort(cols, small=4)
    assert sorted(order) == list(range(500))
    keys = list(zip(*[c[order] for c in cols]))
    assert keys == sorted(keys)


def plan_is_valid(counts, rows, capacity):
    got = collections.Counter()
    for content, times in rows:
        assert sum(content) <= capacity and times > 0
        for n in content:
            got[n] += times
    assert got == collections.Counter({k: v for k, v in counts.items() if v})


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan(seed):
    rng = random.Random(seed)
    counts = collections.Counter(rng.randint(1, 64) for _ in range(300))
    rows = packing.plan(dict(counts), 64)
    plan_is_valid(counts, rows, 64)
    assert sum(t for _, t in rows) <= len(token_output.best_fit_decreasing(list(counts.elements()), 64)) + 1


def test_packing_plan_finds_exact_complements():
    for counts, rows in (({40: 5, 24: 5}, 5), ({40: 2, 14: 2, 10: 2}, 2), ({30: 3, 20: 3, 9: 3, 5: 3}, 3), ({64: 7}, 7), ({}, 0)):
        got = packing.plan(counts, 64)
        plan_is_valid(counts, got, 64)
        assert sum(t for _, t in got) == rows


def tokens(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    return {d: np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4") for d, x in texts.items()}


def test_packing(spark, texts, empty):
    texts = texts | {18: "special <|endoftext|> inside", 19: " \n\n  spaces   and 12345 'll", 20: "é" * 3000}
    want = tokens(texts)
    df = spark.createDataFrame(list(texts.items()), DOCS).withColumn("length", F.lit("clash")).repartition(3)
    pieces, rows = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack(df).collect():
        pieces[r["doc_id"]].append(r)
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(want)
    for d, ps in pieces.items():
        ps.sort(key=lambda r: r["piece"])
        assert [p["piece"] for p in ps] == list(range(len(ps))) and sum(p["length"] for p in ps) == len(want[d])
        assert all(p["length"] == 1024 for p in ps[1:])
        for p in ps:
            assert p["ids_crc32"] == zlib.crc32(want[d][p["start"] : p["start"] + p["length"]].tobytes())
    for places in rows.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack(empty).count() == 0


def test_token_rows_round_trip(spark, texts, empty, tmp_path):
    want = tokens(texts)
    token_output.write(spark.createDataFrame(list(texts.items()), DOCS), str(tmp_path / "rows"), capacity=128)
    got = collections.defaultdict(dict)
    for r in token_output.read(spark, str(tmp_path / "rows")).collect():
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == 128 and r["cu_seqlens"][-1] == r["n_tokens"]
        pos = token_output.positions(r["starts"], r["cu_seqlens"])
        for d, s, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            got[d][s] = ids[a:b]
            assert pos[a] == s
    assert {d: np.concatenate([x[s] for s in sorted(x)]).tolist() for d, x in got.items()} == {d: x.tolist() for d, x in want.items()}
    assert token_output.packed_rows(empty).count() == 0


def test_token_query_reads_what_it_wrote(spark, texts, tmp_path, monkeypatch):
    written, write = [], token_output.write
    monkeypatch.setattr(token_output, "write", lambda docs, target, **k: (written.append(target), write(docs, target, **k)))
    spark.createDataFrame(list(texts.items()), DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["row_id"]: r for r in token_output.op5_token_output(spark, str(tmp_path)).collect()}
    rows = token_output.read(spark, written[0]).collect()
    assert len(written) == 1 and {r["row_id"] for r in rows} == set(got)
    for r in rows:
        pos = token_output.positions(r["starts"], r["cu_seqlens"])
        assert [tuple(x) for x in r["resets"]] == list(zip(r["cu_seqlens"], r["starts"]))
        assert (got[r["row_id"]]["ids_crc32"], got[r["row_id"]]["positions_crc32"]) == (zlib.crc32(r["ids"]), zlib.crc32(pos.astype("<u4").tobytes()))


def test_segment_tree_finds_the_smallest_room():
    tree, held = token_output.CapacityTree(50), collections.Counter()
    rng = random.Random(2)
    for _ in range(500):
        room = rng.randint(0, 50)
        if held[room] and rng.random() < 0.5:
            tree.add(room, -1)
            held[room] -= 1
        else:
            tree.add(room)
            held[room] += 1
        need = rng.randint(0, 50)
        assert tree.at_least(need) == min((r for r in held if held[r] and r >= need), default=None)


def word_sets(texts, width):
    out = {}
    for d, x in texts.items():
        w = [t for t in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or "")) if t]
        out[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    return out


def brute_components(sets, percent):
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in ids}


@pytest.mark.parametrize("width", [4, 5])
def test_near_groups(spark, texts, empty, width):
    rng = random.Random(8)
    base = prose(rng, 100).split()
    texts = dict(texts)
    for k in range(40):  # a large group whose members are linked through one another
        w = base[:]
        for _ in range(k % 6):
            w[rng.randrange(100)] = f"new{rng.randrange(1000)}"
        texts[100 + k] = " ".join(w).upper() if k % 2 else " ".join(w)
    sets = word_sets(texts, width)
    want = brute_components(sets, 80)
    df = spark.createDataFrame(list(texts.items()), DOCS).withColumn("component_id", F.lit("clash")).repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_groups(df, width, 80).collect()}
    assert got == {d: (len(sets[d]), want[d]) for d in texts}
    if width == 4:
        assert near_dedup.near_groups(empty).count() == 0


def test_near_groups_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = random.Random(9)
    base = prose(rng, 60).split()
    texts = {k: " ".join(base[: 30 + k] + [f"w{k}"] + base[31 + k :]) for k in range(25)}
    sets = word_sets(texts, 4)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(spark.createDataFrame(list(texts.items()), DOCS), 4, 80).collect()}
    assert got == brute_components(sets, 80)


@pytest.mark.parametrize("most", [512, 64])
def test_candidates_among_hundreds_of_unlike_documents(spark, monkeypatch, most):
    monkeypatch.setattr(near_dedup, "SKETCHES", most, raising=False)
    rng = np.random.default_rng(6)
    marks = rng.integers(0, 256, (400, near_dedup.COORDINATES)).astype(np.uint8)
    marks[390, :102] = marks[380, :102]  # near copies, far behind the first documents of their bucket
    marks[201, :80] = marks[0, :80]  # like the first document, by little,
    marks[202] = marks[201]
    marks[202, :40] = 255 - marks[0, :40]  # where its near copy is not
    rows = [(i, m.tobytes(), [7]) for i, m in enumerate(marks)]
    edges = near_dedup._candidates(spark.createDataFrame(rows, "node long, marks binary, bands array<long>"))
    label = {r["node"]: r["component"] for r in near_dedup.components(edges, "test").collect()}
    assert label == {380: 380, 390: 380, 0: 0, 201: 0, 202: 0}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, 600).astype(np.uint64)
    for shared in (0, 200, 400, 600):
        b = np.concatenate([a[:shared], rng.integers(0, 2**63, 600 - shared).astype(np.uint64)])
        like = (near_dedup.sketch(np.unique(a)) == near_dedup.sketch(np.unique(b))).mean()
        assert abs(like - shared / (1200 - shared)) < 0.17
    assert len(near_dedup.sketch(a[:1])) == near_dedup.COORDINATES


def item_words(x):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or "")) if w]


def test_decontaminate(spark, texts, empty):
    rng = random.Random(6)
    items = {1: prose(rng, 25), 2: texts[1][:200], 3: "one", 4: "a b", 5: None, 6: "", 10: "Nowhere at all in these texts is this to be found"}
    texts = texts | {50: "before " + items[1].upper() + " after, A-B " + items[1], 51: items[1]}
    want = {}
    for d, x in texts.items():
        w, hit, found = item_words(x), set(), []
        for i, t in items.items():
            t = item_words(t)
            n = min(10, len(t))
            windows = {tuple(t[k : k + n]) for k in range(len(t) - n + 1)} if t else set()
            at = [s for s in range(len(w) - n + 1) if n and tuple(w[s : s + n]) in windows]
            if at:
                found.append(str(i))
            hit |= {p for s in at for p in range(s, s + n)}
        want[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    df = spark.createDataFrame(list(texts.items()), DOCS).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string").withColumn("doc_id", F.lit(0))
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.contamination(df, bench).collect()}
    assert got == want
    assert {r["doc_id"] for r in decontaminate.clean(df, bench).collect()} == {d for d, v in want.items() if not v[4]}
    assert decontaminate.contamination(empty, bench).count() == 0
    none = decontaminate.contamination(df, bench.limit(0)).collect()
    assert len(none) == len(texts) and not any(r["contaminated"] for r in none)


def test_license_scan(spark, empty):
    texts = {
        1: "Licensed under CC BY-NC 4.0.", 2: "all rights reserved. ALL RIGHTS-RESERVED and cc by cc by", 3: None, 4: "", 5: "all rights are reserved", 6: "by cc", 7: "GNU General Public License, version 3",
        8: "permission is hereby granted, free and of charge, to any person obtaining a copy",
    }
    df = spark.createDataFrame([(k, v, "clash") for k, v in texts.items()] + [(7, texts[7], "again")], "doc_id long, text string, label string")
    got = collections.defaultdict(list)
    for r in license_scan.scan(df).collect():
        got[r["doc_id"]].append(r)
    assert len(got[7]) == 2
    one = {k: v[0] for k, v in got.items()}
    base = [(p.split(), label) for p, label in license_scan.BASE]
    for d, x in texts.items():
        w = item_words(x)
        at = [(s, label) for p, label in base for s in range(len(w)) if w[s : s + len(p)] == p]
        r = one[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in at})) and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert "cc-by-nc" in one[1]["labels"] and "mit" in one[8]["labels"] and one[5]["labels"] == ""
    assert license_scan.scan(empty).count() == 0


def test_fingerprints(spark, docs, texts, empty):
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    ids = sorted(texts, reverse=True)

    def shingles(x):
        w = x.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    for k, d in enumerate(ids):
        x, following, r = texts[d] or "", texts[ids[(k + 1) % len(ids)]] or "", got[d]
        half = len(x) // 2
        edited = x[: len(x) - half] + following[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        for a, b, like in ((x, edited, r["near_edited"]), (x, following, r["near_next"])):
            a, b = shingles(a), shingles(b)
            assert abs(like - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.17
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[6]["fingerprint"] == got[7]["fingerprint"] == "" != got[8]["fingerprint"]
    assert fingerprints.fingerprints(empty).count() == 0


def test_next_document_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "NEIGHBOURS", 4)
    ids = [1, 2, 3, 5, 8, 1000, 1001, 5000, 5001, 5002, 9999, 10_000_000]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], DOCS)
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df, ["text"]).collect()}
    assert got == {i: f"t{ids[k - 1]}" for k, i in enumerate(ids)}


def test_chat_replies(spark):
    data = [
        (1, 0, "u", "Hello there\nHow are you today"), (1, 1, "a", "Other topic entirely"), (1, 2, "u", "> Hello there\n> How are you today\nFine thanks"),
        (1, 3, "a", "On Monday bob wrote:\n> Fine thanks\n>> hello   there\nGreat to hear"), (1, 4, "u", "> other TOPIC entirely\nyes"), (1, 4, "u", "> other TOPIC entirely\nyes"),
        (1, 5, "a", "> said by nobody\nok"), (2, 0, None, None), (2, 1, "u", ""), (None, 5, "u", "> x"),
    ]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("thread", F.lit("clash"))
    got = sorted((r["conv_id"] or 0, r["position"], r["turn"], r["parent_turn"], r["thread"], r["depth"], r["text"]) for r in chat_format.reply_ordered(df).collect())
    assert [x[1:6] for x in got if x[0] == 1] == [(0, 0, None, 0, 0), (1, 2, 0, 0, 1), (2, 3, 2, 0, 2), (3, 1, None, 1, 0), (4, 4, 1, 1, 1), (5, 4, 1, 1, 1), (6, 5, None, 5, 0)]
    assert [x[6] for x in got if x[0] == 1][:3] == ["Hello there\nHow are you today", "Fine thanks", "Great to hear"]
    assert [x[1:4] for x in got if x[0] == 2] == [(0, 0, None), (1, 1, None)]
    assert chat_format.reply_ordered(df.limit(0)).count() == 0


def test_positions_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "CHUNK", 3)
    data = [(1, t, "u", f"message number {t}" if t % 4 else f"> message number {t - 1}\nmessage number {t}") for t in range(40)]
    got = sorted((r["position"], r["thread"], r["turn"]) for r in chat_format.reply_ordered(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect())
    assert [g[0] for g in got] == list(range(40)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
    assert got[:1] == [(0, 0, 0)] and (3, 4) in [g[1:] for g in got]
