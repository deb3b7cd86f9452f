"""Reply-ordered conversations from quoted messages, in DataFrame functions only.

Quotation linking: a line's quote level is the number of > marks it starts with.
Lines of level 0 are the message's own; each run of lines of one level, each of
its lines and each of its sentences, wherever lines were broken anew, is a quoted
passage.  Passages are normalised (lower case, single spaces) and joined by hash,
and then by text, to the own passages (whole text, paragraphs, lines, sentences)
of earlier messages of the conversation.  The earliest message
that holds a passage is its origin.  A message replies to the origin of most of
its least nested quoted words (ties: the latest).

A conversation is its threads in the order of their first messages, each in the
order of turns, so a message follows what it replies to; ``position`` counts that
order.  Own texts are given without quotes and without the line that announces
one.  Messages without a known origin start a thread.  Null texts have no lines;
messages of equal conv_id and turn share their replies and follow each other.
Messages of no conv_id or turn reply to none; an empty table gives an empty
result.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import common

#: Rows of one key that a window takes.
CHUNK = 256
MARKS = r"^((?:[ \t]*>)+)[ \t]?"
SENTENCE_END = r"[.!?]+(?:\s+|$)"
ANNOUNCES = r"(?i)^\s*(on\b.*\bwrote|.*\bschrieb|.*\bescribió|.*\ba écrit)\s*:\s*$"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with ``own`` (text without quotes) and ``runs`` (level and lines of each quoted run)."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\r?\n"), lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("line")))

    def join(a: Column, x: Column) -> Column:
        """The runs so far and the next line: it continues the last run of its level or starts one."""
        last = F.get(a, F.size(a) - 1)
        return F.when(
            (F.size(a) > 0) & (last.level == x.level),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(x.level.alias("level"), F.concat(last.lines, F.array(x.line)).alias("lines")))),
        ).otherwise(F.concat(a, F.array(F.struct(x.level.alias("level"), F.array(x.line).alias("lines")))))

    # runs are formed only where there are quotes: all lines of other messages are own
    quoted = F.exists("_lines", lambda x: x.level > 0)
    none = F.array().cast("array<struct<level:int,lines:array<string>>>")
    out = messages.withColumn("_lines", lines)
    out = out.withColumn("runs", F.when(quoted, F.filter(F.aggregate("_lines", none, join), lambda r: r.level > 0)).otherwise(none))
    announced = lambda x, i: ~(x.line.rlike(ANNOUNCES) & (F.coalesce(F.get(F.col("_lines"), i + 1).level, F.lit(0)) > 0))
    kept = F.filter(F.filter("_lines", announced), lambda x: x.level == 0)
    own = F.when(quoted, F.trim(F.array_join(F.transform(kept, lambda x: x.line), "\n"))).otherwise(F.col("text"))
    return out.withColumn("own", own).drop("_lines")


def _passages(pieces: Column) -> Column:
    """Distinct non-empty normalised passages."""
    return F.array_distinct(F.filter(F.transform(pieces, _normal), lambda x: x != ""))


def _sentences(text: Column) -> Column:
    return F.split(text, SENTENCE_END)


def replies(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn) of the messages whose quotes have an origin."""
    rows = parsed(messages.select("conv_id", "turn", "text"))
    own = F.coalesce("own", F.lit(""))
    held = rows.select("conv_id", "turn", F.explode(_passages(F.concat(F.array(own), F.split(own, r"\n\s*\n"), F.split(own, "\n"), _sentences(own)))).alias("passage"))
    run = F.transform("runs", lambda r: F.struct(r.level.alias("level"), _passages(F.concat(F.array(F.array_join(r.lines, "\n")), r.lines, _sentences(F.array_join(r.lines, "\n")))).alias("ps")))
    asked = rows.where(F.size("runs") > 0).select("conv_id", "turn", F.explode(run).alias("r"))
    asked = asked.select("conv_id", "turn", F.col("r.level").alias("level"), F.explode("r.ps").alias("passage")).withColumn("h", F.xxhash64("passage"))
    asked = common.materialise(asked, "quotes")
    # only passages that some message quotes need an origin; one row, the earliest, for each
    wanted = asked.select("conv_id", "h").distinct()
    origins = held.withColumn("h", F.xxhash64("passage")).join(wanted, ["conv_id", "h"], "left_semi").groupBy("conv_id", "h", "passage").agg(F.min("turn").alias("origin"))
    linked = asked.join(origins, ["conv_id", "h", "passage"]).where(F.col("origin") < F.col("turn"))
    votes = linked.groupBy("conv_id", "turn", "level", "origin").agg(F.sum(F.size(F.split("passage", " "))).alias("votes"))
    best = votes.groupBy("conv_id", "turn").agg(F.max(F.struct((-F.col("level")).alias("l"), "votes", "origin")).alias("b"))
    return best.select("conv_id", "turn", F.col("b.origin").alias("parent_turn"))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, thread, depth): the first message that replies lead to, by pointer doubling."""
    now = common.materialise(links.select("conv_id", "turn", "parent_turn", F.col("parent_turn").alias("thread"), F.lit(1).alias("depth")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("_up"), F.col("depth").alias("_more"))
        after = now.join(up, ["conv_id", "thread"], "left")
        after = after.select("conv_id", "turn", "parent_turn", F.coalesce("_up", "thread").alias("thread"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), F.col("_up").isNotNull().alias("moved"))
        after = common.materialise(after, "threads")
        now = after.drop("moved")
        if after.where("moved").limit(1).count() == 0:
            return now


def _before(rows: DataFrame, keys: list[str], order: str, amount: Column, ties: list[Column], out: str) -> DataFrame:
    """rows with ``out``: the sum of amount over the key's rows that come earlier.

    Windows take one chunk of order values of a key, and one row for each chunk of a key.
    """
    rows = rows.withColumn("_c", F.floor(F.col(order) / CHUNK)).withColumn("_a", amount)
    inside = Window.partitionBy(*keys, "_c").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    total = rows.groupBy(*keys, "_c").agg(F.sum("_a").alias("_t"))
    chunks = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_c").alias("_d"), F.coalesce(F.sum("_t").over(chunks), F.lit(0)).alias("_b"))
    same = F.col("_c").eqNullSafe(F.col("_d"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = rows.withColumn("_w", F.coalesce(F.sum("_a").over(inside), F.lit(0))).join(total, same)
    return joined.withColumn(out, F.col("_b") + F.col("_w")).drop("_c", "_a", "_d", "_b", "_w", *[f"_{k}" for k in keys])


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, text without quotes, n_quotes, parent_turn, thread, depth, position."""
    messages = messages.select("conv_id", "turn", "role", "text")
    found = threads(replies(messages)).withColumnsRenamed({"conv_id": "_i", "turn": "_t"})
    rows = parsed(messages).select("conv_id", "turn", "role", F.col("own").alias("text"), F.size("runs").cast("long").alias("n_quotes"))
    rows = rows.join(found, (F.col("conv_id") == F.col("_i")) & (F.col("turn") == F.col("_t")), "left").drop("_i", "_t")
    rows = rows.withColumn("thread", F.coalesce("thread", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0)))
    rows = common.materialise(rows, "messages")
    sizes = rows.groupBy("conv_id", "thread").agg(F.count("*").alias("n"))
    starts = _before(sizes, ["conv_id"], "thread", F.col("n"), [], "start").select(F.col("conv_id").alias("_i"), F.col("thread").alias("_h"), "start")
    placed = _before(rows, ["conv_id", "thread"], "turn", F.lit(1), [F.col("role"), F.xxhash64("text")], "inside")
    both = placed.join(starts, F.col("conv_id").eqNullSafe(F.col("_i")) & F.col("thread").eqNullSafe(F.col("_h")))
    return both.select("conv_id", "turn", "role", "text", "n_quotes", "parent_turn", "thread", "depth", (F.col("start") + F.col("inside")).cast("long").alias("position"))


def conversation_text(ordered: DataFrame, most: int = 10_000) -> DataFrame:
    """(conv_id, part, messages, chat): role and text of each conversation in order, and the same as one marked-up text.

    Every ``most`` messages start another part, so that no row holds a conversation of any length.
    """
    parts = ordered.groupBy("conv_id", F.floor(F.col("position") / most).alias("part")).agg(F.array_sort(F.collect_list(F.struct("position", "role", "text"))).alias("m"))
    said = F.transform("m", lambda x: F.concat(F.lit("<|"), F.coalesce(x.role, F.lit("")), F.lit("|>\n"), F.coalesce(x.text, F.lit("")), F.lit("\n")))
    return parts.select("conv_id", "part", F.transform("m", lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))).alias("messages"), F.array_join(said, "").alias("chat"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reply_ordered(common.table(spark, sf_dir, "conversations"))
    return out.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).drop("text")


OP9_SQL = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS id, conv_id, turn, role, text, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) AS ls FROM conversations),
ln AS (
  SELECT id, conv_id, turn, i, len(regexp_replace(regexp_extract(ls[i], '^((?:[ \t]*>)+)[ \t]?', 1), '[^>]', '', 'g')) AS level, regexp_replace(ls[i], '^((?:[ \t]*>)+)[ \t]?', '') AS line
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM m)),
st AS (SELECT *, CASE WHEN lag(level) OVER w = level THEN 0 ELSE 1 END AS new, coalesce(lead(level) OVER w, 0) AS following FROM ln WINDOW w AS (PARTITION BY id ORDER BY i)),
rn AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY i) AS run FROM st),
ow AS (
  SELECT id, trim(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (level = 0 AND NOT (following > 0 AND regexp_matches(line, '(?i)^\s*(on\b.*\bwrote|.*\bschrieb|.*\bescribió|.*\ba écrit)\s*:\s*$'))), '')) AS own,
    max(level) > 0 AS quotes, count(DISTINCT CASE WHEN level > 0 THEN run END) AS n_quotes FROM rn GROUP BY id),
ms AS (SELECT m.*, CASE WHEN quotes THEN own ELSE text END AS own, n_quotes FROM m JOIN ow USING (id)),
hp AS (
  SELECT conv_id, turn, trim(regexp_replace(lower(unnest(list_concat([coalesce(own, '')], regexp_split_to_array(coalesce(own, ''), '\n\s*\n'), string_split(coalesce(own, ''), chr(10)), regexp_split_to_array(coalesce(own, ''), '[.!?]+(?:\s+|$)')))), '\s+', ' ', 'g')) AS passage FROM ms),
og AS (SELECT conv_id, passage, min(turn) AS origin FROM hp WHERE passage <> '' GROUP BY conv_id, passage),
qr AS (SELECT id, conv_id, turn, level, run, list(line ORDER BY i) AS ls FROM rn WHERE level > 0 GROUP BY id, conv_id, turn, level, run),
qp AS (
  SELECT DISTINCT id, run, conv_id, turn, level, trim(regexp_replace(lower(piece), '\s+', ' ', 'g')) AS passage
  FROM (SELECT *, unnest(list_concat([array_to_string(ls, chr(10))], ls, regexp_split_to_array(array_to_string(ls, chr(10)), '[.!?]+(?:\s+|$)'))) AS piece FROM qr)),
vt AS (
  SELECT conv_id, turn, level, origin, sum(len(string_split(passage, ' '))) AS votes FROM qp JOIN og USING (conv_id, passage) WHERE passage <> '' AND origin < turn GROUP BY conv_id, turn, level, origin),
pa AS (SELECT conv_id, turn, origin AS parent_turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, votes DESC, origin DESC) AS k FROM vt) WHERE k = 1),
up AS (
  SELECT conv_id, turn, parent_turn AS thread, 1 AS depth FROM pa
  UNION ALL SELECT u.conv_id, u.turn, p.parent_turn, u.depth + 1 FROM up u JOIN pa p ON u.conv_id = p.conv_id AND u.thread = p.turn),
th AS (SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM up GROUP BY conv_id, turn),
al AS (
  SELECT ms.conv_id, ms.turn, role, own, n_quotes, parent_turn, coalesce(thread, ms.turn) AS thread, coalesce(depth, 0) AS depth
  FROM ms LEFT JOIN pa ON ms.conv_id = pa.conv_id AND ms.turn = pa.turn LEFT JOIN th ON ms.conv_id = th.conv_id AND ms.turn = th.turn)
SELECT conv_id, turn, role, CAST(n_quotes AS BIGINT) AS n_quotes, parent_turn, thread, CAST(depth AS INT) AS depth,
  row_number() OVER (PARTITION BY conv_id ORDER BY thread, turn, role) - 1 AS position, sha256(coalesce(own, '')) AS text_sha256 FROM al
"""
