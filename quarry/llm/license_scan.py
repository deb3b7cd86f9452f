"""License and rights statements found by diagonal voting, in DataFrame functions only.

All of a document's rolling word 2-grams are hashed and joined to the positions
of the templates' 2-grams.  A match at word w of the document and word t of a
template votes for the diagonal w - t, where the template would start.  Votes
are counted for each diagonal; a diagonal and those up to ``SHIFT`` words behind
it (words were put in or left out) are merged to a span, which is as much longer
than its template at most.  A span is verified: its 2-grams are compared as words
and not only as hashes, ``LEAST_SHARE`` of the template's stand in it, and one of
them is of no template with another label.  A full diagonal of a base phrase is
an exact occurrence of it.

Templates are a small parameter table.  Null and empty texts have no words and
one row like all others; an empty table gives an empty result.  Every row is a
document of its own, also where rows share a doc_id or have none.  Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

GRAM = 2
#: Words that may be put into a statement, or left out, in all.
SHIFT = 3
#: Share of a template's 2-grams that a span needs: one word less, more or other breaks two at most.
LEAST_SHARE = 0.6
#: The phrases and labels of the base scan.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
#: Statements that the method labels besides.
MORE = [
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("licensed under cc by nd", "cc-by-nd"),
    ("creative commons attribution share alike international license", "cc-by-sa"),
    ("creative commons attribution noncommercial international license", "cc-by-nc"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("licensed under the gnu general public license version", "gnu"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license version", "mpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("dedicated to the public domain", "public-domain"),
    ("this is free and unencumbered software released into the public domain", "public-domain"),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "no-warranty"),
]
#: Stands for a document among its 2-grams, so that those without any match stay; no 2-gram of words is like it.
_SELF = "\n"


def templates(base=BASE, more=MORE) -> list[tuple[int, str, bool, list[str]]]:
    """(number, label, whether base, words); phrases of fewer than GRAM words can't be voted for."""
    return [(i, label, i < len(base), phrase.split()) for i, (phrase, label) in enumerate([*base, *more]) if len(phrase.split()) >= GRAM]


def _positions(base=BASE, more=MORE) -> list[tuple[int, str, bool, int, int, str, bool]]:
    """(template, label, whether base, 2-grams in all, position, 2-gram, whether only this label's templates hold it)."""
    known = templates(base, more)
    grams = [(t, label, b, len(w) - GRAM + 1, k, " ".join(w[k : k + GRAM])) for t, label, b, w in known for k in range(len(w) - GRAM + 1)]
    labels: dict[str, set] = {}
    for g in grams:
        if not g[2]:
            labels.setdefault(g[5], set()).add(g[1])
    return [(*g, g[2] or len(labels[g[5]]) == 1) for g in grams]


def scan(docs: DataFrame, base=BASE, more=MORE) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    table = spark.createDataFrame(_positions(base, more), "template int, label string, base boolean, grams int, t int, gram string, own boolean")
    table = table.union(spark.createDataFrame([(None, None, None, None, None, _SELF, None)], table.schema)).withColumn("h", F.xxhash64("gram"))
    tokens = F.array_remove(F.split(F.coalesce(common.lower_ascii(F.col("text")), F.lit("")), common.NOT_WORD), "")
    pairs = lambda w: F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - (GRAM - 1), F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1)))
    rolled = common.let(tokens, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.concat(pairs(w), F.array(F.lit(_SELF))).alias("grams")))
    rows = docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("row"), rolled.alias("r"))
    rows = rows.select("doc_id", "row", F.col("r.n").alias("n_words"), F.posexplode("r.grams").alias("w", "said")).withColumn("h", F.xxhash64("said"))
    # a few hundred template positions
    voted = rows.join(F.broadcast(table), "h").where("gram = said")
    key = ["doc_id", "row", "n_words", "template", "label", "base", "grams"]
    place = F.struct("t", "own")
    diagonals = voted.groupBy(*key, (F.col("w") - F.col("t")).alias("d")).agg(F.collect_set(F.when(F.col("t").isNotNull(), place)).alias("ts"))
    per = diagonals.groupBy(*key).agg(F.array_sort(F.collect_list(F.when(F.col("d").isNotNull(), F.struct("d", "ts")))).alias("ds"))

    def span(x, i):
        """Template positions on a diagonal and on those behind it that are near enough."""
        near = F.filter(F.slice(F.col("ds"), i + 1, F.lit(SHIFT + 1)), lambda y: y.d <= x.d + SHIFT)
        return F.array_distinct(F.flatten(F.transform(near, lambda y: y.ts)))

    spans = F.filter(F.transform("ds", span), lambda ts: F.exists(ts, lambda t: t.own) & (F.size(ts) >= LEAST_SHARE * F.col("grams")))
    best = F.array_max(F.transform(spans, lambda ts: F.size(ts))) / F.col("grams")
    exact = F.transform(F.filter("ds", lambda x: F.col("base") & (F.size(x.ts) == F.col("grams"))), lambda x: x.d)
    out = per.select("doc_id", "row", "n_words", "label", "base", exact.alias("exact"), best.alias("share"))
    is_base = F.size("exact") > 0
    # a base label needs an exact occurrence of its phrase
    found = F.when(F.col("base"), is_base).otherwise(F.col("share").isNotNull())
    out = out.groupBy("doc_id", "row", "n_words").agg(
        F.coalesce(F.sum(F.when(is_base, F.size("exact"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(is_base, F.array_min("exact"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.array_max("exact"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(found, F.when(F.col("base"), F.lit(1.0)).otherwise(F.col("share")))), F.lit(0.0)).alias("score"),
    )
    return out.drop("row")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.documents(spark, sf_dir))


def _values() -> str:
    return ",\n".join(f"({t}, '{label}', {str(b).lower()}, {n}, {k}, '{gram}', {str(own).lower()})" for t, label, b, n, k, gram, own in _positions())


OP8_SQL = f"""
WITH tpl(template, label, base, grams, t, gram, own) AS (VALUES {_values()}),
dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i - 1 AS p, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM dw)),
vote AS (SELECT DISTINCT doc_id, template, label, base, grams, p - t AS d, t, own FROM g JOIN tpl USING (gram)),
span AS (
  SELECT a.doc_id, a.template, a.label, a.grams, a.d, count(DISTINCT v.t) / a.grams AS share
  FROM (SELECT DISTINCT doc_id, template, label, grams, d FROM vote WHERE NOT base) a
  JOIN vote v ON a.doc_id = v.doc_id AND a.template = v.template AND v.d BETWEEN a.d AND a.d + {SHIFT}
  GROUP BY a.doc_id, a.template, a.label, a.grams, a.d HAVING bool_or(v.own) AND count(DISTINCT v.t) >= {LEAST_SHARE} * a.grams),
ex AS (SELECT doc_id, template, label, d FROM vote WHERE base GROUP BY doc_id, template, label, grams, d HAVING count(*) = grams),
b AS (
  SELECT doc_id, count(*) AS n_base, min(d) AS first_word, max(d) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM ex GROUP BY doc_id),
l AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT doc_id, label, share FROM span UNION ALL SELECT doc_id, label, 1.0 FROM ex) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM dw LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)
"""
