"""Rows that share a doc_id or have none, equal rows, very long texts, tables of one hot key: each row is a document."""

import hashlib
import random
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/", 1)[0])

from test_llm_exact import DOCS, brute_components, prose, word_sets  # noqa: E402

from quarry.llm import chat_format, decontaminate, fingerprints, license_scan, near_dedup, packing, suffix_dedup, token_output


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    a, b, long = prose(rng, 60), prose(rng, 60), prose(rng, 160_000)
    return [(1, a), (1, a), (1, b), (2, a + " and more"), (3, b + " and more"), (None, a), (None, None), (None, a), (4, long), (5, long[:700_000]), (6, ""), (6, "")]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumns({"text_hash": F.lit("clash"), "node": F.lit(1), "key": F.lit(2), "c": F.lit("x"), "__key": F.lit(0)}).repartition(3)


def plain_repeats(texts, span=100):
    """(n_bytes, n_removed, sha256 of the rest) of each text; texts stand in the order of documents."""
    seen, out = set(), []
    for t in texts:
        data = (t or "").encode()
        reach, left = 0, bytearray()
        for s in range(len(data)):
            w = data[s : s + span]
            if len(w) == span and w in seen:
                reach = s + span
            elif len(w) == span:
                seen.add(w)
            if s >= reach:
                left.append(data[s])
        out.append((len(data), len(data) - len(left), hashlib.sha256(bytes(left)).hexdigest()))
    return out


def test_suffix_dedup_keeps_the_first_of_equal_rows(spark, rows, frame):
    rows = [r for r in rows if len(r[1] or "") < 10_000]
    hashed = {r["text"]: r["h"] for r in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashed[r[1]]))
    want = Counter((d, *x) for (d, _), x in zip(order, plain_repeats([t for _, t in order])))
    got = suffix_dedup.digest(frame.where("coalesce(length(text), 0) < 10000")).select("doc_id", "n_bytes", "n_removed", "kept_sha256")
    assert Counter(map(tuple, got.collect())) == want


def test_suffix_dedup_of_very_long_texts(spark, rows, frame):
    got = {r["doc_id"]: r for r in suffix_dedup.digest(frame.where("doc_id in (4, 5)")).collect()}
    assert got[4]["n_removed"] == 0 and got[5]["n_removed"] == got[5]["n_bytes"] == 700_000


def test_suffixes_of_one_leading_token_go_to_many_buckets(spark):
    rng = random.Random(2)
    docs = [(i, "".join("start" + str(rng.randrange(10**12)).zfill(40) for _ in range(30))) for i in range(60)]
    df = spark.createDataFrame(docs, DOCS)
    splitters = suffix_dedup._splitters(df, 16, 100, 32)
    assert len(splitters) == 15
    want = Counter((d, *x) for (d, _), x in zip(docs, plain_repeats([t for _, t in docs])))
    assert Counter(map(tuple, suffix_dedup.digest(df).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect())) == want


def test_decontaminate_gives_a_row_for_a_row(spark, rows, frame):
    words = rows[0][1].split()
    bench = spark.createDataFrame([(7, " ".join(words[5:20])), (8, " ".join(words[5:20])), (9, "nothing like it")], "item_id long, text string")
    got = decontaminate.contamination(frame, bench).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in got) == Counter((d, len((t or "").split())) for d, t in rows)
    holds = [" ".join(words[5:20]) in (t or "") for _, t in rows]
    assert Counter((r["doc_id"], r["contaminated"], r["n_hit"], r["n_items"]) for r in got) == Counter((d, h, 15 * h, 2 * h) for (d, _), h in zip(rows, holds))
    left = decontaminate.clean(frame, bench)
    assert left.columns == frame.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(r for r, h in zip(rows, holds) if not h)


def test_near_groups_of_rows_that_share_ids(spark, rows, frame):
    some = [r for r in rows if len(r[1] or "") < 10_000]
    place = {i: (d is None, d or 0) for i, (d, _) in enumerate(some)}
    root = brute_components(word_sets({i: t for i, (_, t) in enumerate(some)}, 4), 80)
    least = {}
    for i, r in root.items():
        least[r] = min(least.get(r, place[i]), place[i])
    want = Counter((d, None if least[root[i]][0] else least[root[i]][1]) for i, (d, _) in enumerate(some))
    got = near_dedup.near_groups(frame.where("coalesce(length(text), 0) < 10000"), 4, 80).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == want
    assert sum(r["leader"] for r in got if r["n_shingles"]) == 3  # the equal rows 1, and b


@pytest.mark.parametrize("seed", range(6))
def test_packing_takes_no_more_rows_than_best_fit_decreasing(seed):
    rng = random.Random(seed)
    counts = Counter(min(1024, int(rng.paretovariate(0.7) * 20)) for _ in range(3000))
    rows = packing.plan(dict(counts))
    assert sum(t for _, t in rows) <= len(token_output.best_fit_decreasing(list(counts.elements()), 1024))
    assert sum((Counter({n: k * t for n, k in Counter(x).items()}) for x, t in rows), Counter()) == counts


def test_next_document_beside_an_outlier(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "NEIGHBOURS", 4)
    ids = [*range(100), 2**62]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], DOCS)
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df, ["text"]).collect()}
    assert got == {i: f"t{ids[k - 1]}" for k, i in enumerate(ids)}
    number = fingerprints._range_of(F.col("doc_id"), [10, 20, 30, 40, 50, 60, 70])
    assert [r[0] for r in df.where("doc_id in (0, 9, 10, 35, 69, 70, 99)").orderBy("doc_id").select(number).collect()] == [0, 0, 1, 3, 6, 7, 7]


def test_statements_with_a_word_put_in_left_out_or_changed(spark):
    texts, want, own = [], [], {}
    for g in license_scan._positions():
        own.setdefault(g[1], set()).update([g[5]] if g[6] else [])
    for phrase, label in license_scan.MORE:
        w = phrase.split()
        middle = len(w) // 2
        texts.append(" ".join(["intro"] * 9 + w + ["outro"] * 9))
        texts.append(" ".join(["intro", *w[:middle], "really", *w[middle:], "outro"]))  # a word put in
        want += [label, label]
        for other in ([], ["really"]):  # left out, another word: not the one that tells the label
            t = [*w[: middle - 1], *other, *w[middle:]]
            if len(w) >= 7 and own[label] & {" ".join(x) for x in zip(t, t[1:])}:
                texts.append(" ".join(t))
                want.append(label)
    none = ["released under z under the z the mit z mit license", "the general public has no license version", "licensed under the table by the public", "license the mit under released", "apache license"]
    texts += ["Released under the terms of the MIT License", *none]
    want += ["mit"]
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    for i, label in enumerate(want):
        assert label in got[i]["labels"].split(","), (texts[i], got[i])
        assert {x for x in got[i]["labels"].split(",")} <= {label, "cc-by", "gpl", "gnu"}, (texts[i], got[i])
    assert [got[len(want) + i]["labels"] for i in range(len(none))] == [""] * len(none)


def test_license_scan_gives_a_row_for_a_row(rows, frame):
    got = license_scan.scan(frame).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in got) == Counter((d, len((t or "").split())) for d, t in rows)


def test_hundreds_of_quotes_find_their_messages(spark, tmp_path):
    rng = random.Random(14)
    rows, want = [], {}
    for conv in range(25):
        said: list[list[str]] = []
        for turn in range(16):
            sentences = [prose(rng, rng.randrange(6, 14)).capitalize() for _ in range(rng.randrange(2, 5))]
            quote = []
            if turn:
                of = rng.randrange(turn)
                kind = rng.randrange(3)
                quoted = " ".join(x + "." for x in (said[of] if kind == 0 else rng.sample(said[of], 1)))  # all of it, or a sentence
                words = quoted.split()
                step = len(words) if kind == 1 else 5  # as one line, or broken anew
                quote = [f"On day {of} somebody wrote:"] + ["> " + " ".join(words[i : i + step]) for i in range(0, len(words), step)]
                if rng.random() < 0.4:
                    quote.append(">> something older that nobody wrote")
                want[conv, turn] = of
            own = " ".join(x + "." for x in sentences)
            said.append(sentences)
            rows.append((conv, turn, "user", "\n".join([*quote, own])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("passage", F.lit("clash")).repartition(3)
    ordered = chat_format.reply_ordered(df)
    got = {(r["conv_id"], r["turn"]): r for r in ordered.collect()}
    assert len(got) == len(rows)
    assert {k: r["parent_turn"] for k, r in got.items() if r["parent_turn"] is not None} == want
    assert not any(line.startswith(">") or "wrote:" in line for r in got.values() for line in r["text"].split("\n"))
    for conv in range(25):
        place = {t: got[conv, t]["position"] for t in range(16)}
        assert sorted(place.values()) == list(range(16)) and all(place[t] > place[want[conv, t]] for t in range(1, 16))
    duckdb = pytest.importorskip("duckdb")
    df.select("conv_id", "turn", "role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    query = chat_format.op9_chat_format(spark, str(tmp_path))
    assert sorted(map(repr, (tuple(r) for r in query.select(sorted(query.columns)).collect()))) == sorted(map(repr, con.sql(f"SELECT {', '.join(sorted(query.columns))} FROM ({chat_format.OP9_SQL})").fetchall()))
    parts = chat_format.conversation_text(ordered, 6).collect()
    assert Counter(len(r["messages"]) for r in parts) == {6: 50, 4: 25} and all(r["chat"].startswith("<|user|>\n") for r in parts)
