"""Chat formatting: quotation linking, in DataFrame functions only.

A message's lines are parsed into quote levels (leading '>' marks, with blanks between them) and
unquoted lines. Quoted passages (runs of lines of one level) are normalised (marks and outer
blanks off, A-Z lower-cased, runs of white space to one blank) and hashed. The same hash of every
message's own text, of each of its own lines, and of those runs of its lines that start like a passage of
several lines and are as long (blank lines left out) is the index that passages are joined to: a passage
is linked to an earlier message of its conversation (the latest such turn) or, failing that, to the
first message of the first other one. A message replies to the message that its outermost linked quote
names, else to the turn before it.

Replies form a tree. Runs of messages that reply to the turn before make threads; a message that
quotes an older one opens a thread there. Conversations come back in the tree's preorder, without
quotes: a thread's messages, then the threads that leave it, those from its later messages first.
Only threads carry paths, doubled in length by each join, so their depth costs the logarithm of joins.

Nothing needs all rows of a conversation in one task: places and threads come from windows over
blocks of BLOCK turns and over one row a block, and the final order is a range sort. A quote finds the latest
earlier turn with its hash by an as-of window over the turns of one hash, conversation and block, and what came
before the block in one row. Beyond the conversation the index is pre-aggregated to one row a hash (with the first two
conversations, one of which is another than the quoting one). No list of a hash's places is ever built.

Defined cases: null text is empty; a null turn sorts first and replies to nothing; a repeated
(conv_id, turn) keeps both rows, ordered by role and text; rows equal in all of these are interchangeable; a
message of quotes alone has empty text; texts of any length are parsed in time that grows with their length;
null conv_ids are one conversation, before all others; blank passages link to nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 4096
MARKS = r"^[ \t]*((?:>[ \t]?)+)"


def normal(text: Column) -> Column:
    squeezed = F.regexp_replace(F.translate(text, _UPPER, _LOWER), r"[\x20\x09-\x0D]+", " ")
    return F.trim(squeezed)


def digest(text: Column) -> Column:
    return F.when(text != "", F.sha2(text, 256))


def parse(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, block, r (place in its block of turns), own (unquoted text), passages (level, body)."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"\r\n?", "\n")
    block = F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK)
    place = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    lines = F.transform(
        F.split(text, "\n"),
        lambda x: F.struct(
            (F.length(F.regexp_extract(x, MARKS, 1)) - F.length(F.translate(F.regexp_extract(x, MARKS, 1), ">", "")))
            .cast("int").alias("level"),
            F.regexp_replace(x, MARKS, "").alias("body"),
        ),
    )
    # the first and last lines of the runs of one level, then each run's lines
    level = lambda i: F.element_at("lines", i.cast("int"))["level"]
    last = F.size("lines")
    at = F.sequence(F.lit(1), last)
    heads = F.filter(at, lambda i: (level(i) > 0) & ((i == 1) | (level(F.greatest(i - 1, F.lit(1))) != level(i))))
    tails = F.filter(at, lambda i: (level(i) > 0) & ((i == last) | (level(F.least(i + 1, last)) != level(i))))
    body = lambda i, j: F.array_join(F.transform(F.slice("lines", i, j - i + 1), lambda x: x["body"]), "\n")
    passages = F.zip_with(heads, tails, lambda i, j: F.struct(level(i).alias("level"), body(i, j).alias("body")))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    return (
        messages.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            "role",
            "text",
            block.alias("block"),
            lines.alias("lines"),
        )
        .withColumn("r", F.row_number().over(place))
        .select("conv_id", "turn", "role", "block", "r", F.trim(own).alias("own"), passages.alias("passages"))
    )


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which a null conv_id equals a null one."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) if k == "conv_id" else F.col(k) == F.col(f"_{k}") for k in keys]
    return left.join(right, same, how).drop(*(f"_{k}" for k in keys))


def _lines(text: Column) -> Column:
    """The normalised lines that are not blank."""
    return F.filter(F.transform(F.split(text, "\n"), normal), lambda x: x != "")


def _runs(parsed: DataFrame, quoted: DataFrame) -> DataFrame:
    """conv_id, n, hash of the runs of own lines that start with the first line of a longer passage and are as long."""
    # one row a first line, with the lengths of the passages that start with it
    heads = quoted.filter(F.size("lines") > 1).groupBy(digest(F.col("lines")[0]).alias("head")).agg(
        F.collect_set(F.size("lines")).alias("sizes")
    )
    own = parsed.select("conv_id", "n", _lines(F.col("own")).alias("lines")).filter(F.size("lines") > 1)
    starts = own.select("conv_id", "n", F.posexplode("lines").alias("at", "line")).select("conv_id", "n", "at", digest(F.col("line")).alias("head"))
    runs = starts.join(heads, "head").select("conv_id", "n", "at", F.explode("sizes").alias("size"))
    # one row a message meets its lines again
    places = runs.groupBy("conv_id", "n").agg(F.collect_set(F.struct("at", "size")).alias("places"))
    fits = F.filter("places", lambda x: x["at"] + x["size"] <= F.size("lines"))
    text = F.transform(fits, lambda x: digest(F.array_join(F.slice("lines", x["at"] + 1, x["size"]), " ")))
    return _join(own, places, ["conv_id", "n"]).select("conv_id", "n", F.explode(F.array_distinct(text)).alias("hash"))


def link(parsed: DataFrame) -> DataFrame:
    """conv_id, n, level, to_conv, to_n: the original of each quoted passage that has one."""
    whole = F.array(digest(normal(F.col("own"))))
    each = F.transform(F.split("own", "\n"), lambda x: digest(normal(x)))
    quoted = parsed.select("conv_id", "n", F.posexplode("passages").alias("k", "p")).select(
        "conv_id", "n", "k", F.col("p.level").alias("level"), digest(normal(F.col("p.body"))).alias("hash"), _lines(F.col("p.body")).alias("lines")
    ).filter("hash IS NOT NULL")
    originals = parsed.select("conv_id", "n", F.explode(F.array_distinct(F.concat(whole, each))).alias("hash")).filter(
        "hash IS NOT NULL"
    ).unionByName(_runs(parsed, quoted))
    quoted = quoted.drop("lines")
    # only hashes that anyone quotes; one row a hash and conversation, then one row a hash
    wanted = quoted.select("hash").distinct()
    index = originals.join(wanted, "hash", "left_semi")
    order = Window.partitionBy("hash").orderBy(F.col("conv_id").asc_nulls_first())
    there = (
        index.groupBy("hash", "conv_id").agg(F.min("n").alias("n"))
        .withColumn("rank", F.row_number().over(order)).filter("rank <= 2")
        .groupBy("hash").agg(F.sort_array(F.collect_list(F.struct("rank", "conv_id", "n"))).alias("firsts"))
    )
    found = _latest(quoted, index).join(there, "hash", "left")
    other = F.get(F.filter("firsts", lambda x: ~x["conv_id"].eqNullSafe(F.col("conv_id"))), F.lit(0))
    return found.select(
        "conv_id",
        "n",
        "k",
        "level",
        F.when(F.col("to_here").isNotNull(), F.col("conv_id")).otherwise(other["conv_id"]).alias("to_conv"),
        F.coalesce("to_here", other["n"]).alias("to_n"),
    ).filter("to_n IS NOT NULL")


def _latest(quoted: DataFrame, index: DataFrame) -> DataFrame:
    """quoted with to_here, the latest n before its own at which the index has its hash in its conversation."""
    block = F.floor(F.col("n") / BLOCK).alias("block")
    keys = ["hash", "conv_id"]
    places = index.select(*keys, "n", block, F.col("n").alias("place"), F.lit(None).cast("int").alias("k"), F.lit(None).cast("int").alias("level"))
    rows = places.unionByName(quoted.select(*keys, "n", block, F.lit(None).cast("int").alias("place"), "k", "level"))
    # a message's quotes come before its own lines
    past = Window.partitionBy(*keys, "block").orderBy("n", F.col("place").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    rows = _carry(rows, F.col("place"), F.max, keys).withColumn("to_here", F.coalesce(F.max("place").over(past), "before"))
    return rows.filter("k IS NOT NULL").select("conv_id", "n", "k", "level", "hash", "to_here")


def _carry(rows: DataFrame, value: Column, how, keys: list[str] | None = None) -> DataFrame:
    """rows with before: how(value) over the blocks of the same keys that precede the row's block."""
    keys = keys or ["conv_id"]
    blocks = rows.groupBy(*keys, "block").agg(how(value).alias("x"))
    past = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(*keys, "block", how("x").over(past).alias("before"))
    return _join(rows, before, [*keys, "block"], "left")


def _threads(joined: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, thread (place of its first message), path: one row a thread that leaves another one."""
    opened = scratch.write(joined.filter("opens AND n > 1").select("conv_id", "n", "reply_to"))
    at = joined.select("conv_id", F.col("n").alias("reply_to"), F.col("thread").alias("parent"))
    step = F.struct((-F.col("reply_to")).alias("at"), F.col("n").alias("first"))
    todo = scratch.write(_join(opened, at, ["conv_id", "reply_to"]).select("conv_id", F.col("n").alias("thread"), "parent", step.alias("step")))
    # a thread points to its parent, unless that is a first thread, whose path is empty
    known = todo.select("conv_id", F.col("thread").alias("parent"), F.lit(True).alias("known"))
    now = scratch.write(
        _join(todo, known, ["conv_id", "parent"], "left").select(
            "conv_id", "thread", F.when(F.col("known"), F.col("parent")).alias("up"), F.array("step").alias("path")
        )
    )
    while not now.filter("up IS NOT NULL").isEmpty():
        # the path to the thread that a thread points to comes before its own, and it points where that one does
        above = now.select("conv_id", F.col("thread").alias("up"), F.col("up").alias("next"), F.col("path").alias("head"))
        moved = _join(now.filter("up IS NOT NULL"), above, ["conv_id", "up"])
        moved = moved.select("conv_id", "thread", F.col("next").alias("up"), F.concat("head", "path").alias("path"))
        then = scratch.write(now.filter("up IS NULL").unionByName(moved))
        scratch.drop(now)
        now = then
    return now.drop("up")


def conversations(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """Every message, range-sorted in reply order.

    conv_id, n (place by turn), turn, role, reply_to (the place replied to), thread (place of the
    thread's first message), depth (of the thread), n_quotes, n_linked, text.
    """
    ranked = parse(messages)
    counts = _carry(ranked, F.lit(1), F.sum)
    parsed = scratch.write(
        counts.withColumn("n", (F.col("r") + F.coalesce("before", F.lit(0))).cast("int")).drop("before", "r")
    )
    links = (
        link(parsed)
        .groupBy("conv_id", "n")
        .agg(
            F.min(F.when(F.col("to_conv").eqNullSafe(F.col("conv_id")), F.struct("level", "k", "to_n")))["to_n"].alias("to"),
            F.count("*").alias("n_linked"),
        )
    )
    joined = _join(parsed, links, ["conv_id", "n"], "left").withColumn(
        "reply_to", F.coalesce("to", F.when(F.col("n") > 1, F.col("n") - 1)).cast("int")
    )
    joined = joined.withColumn("block", F.floor(F.col("n") / BLOCK)).withColumn(
        "opens", (F.col("n") == 1) | (F.col("reply_to") < F.col("n") - 1)
    )
    first = F.when(F.col("opens"), F.col("n"))
    here = Window.partitionBy("conv_id", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    joined = scratch.write(
        _carry(joined, first, F.max).withColumn("thread", F.coalesce(F.max(first).over(here), "before")).drop("before")
    )
    out = _join(joined, _threads(joined, scratch), ["conv_id", "thread"], "left").withColumn(
        "path", F.coalesce("path", F.expr("CAST(array() AS array<struct<at:int,first:int>>)"))
    )
    return out.orderBy("conv_id", "path", "n").select(
        "conv_id",
        "n",
        "turn",
        "role",
        "reply_to",
        "thread",
        F.size("path").alias("depth"),
        F.size("passages").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("own").alias("text"),
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(table(spark, sf_dir, "conversations"), Scratch(spark, "op3"))


OP3_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS text,
         CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS INTEGER) AS n
  FROM conversations
), l AS (
  SELECT conv_id, n, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM t
), p AS (
  SELECT conv_id, n, i, regexp_replace(line, '^[ \t]*((?:>[ \t]?)+)', '') AS body,
         length(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1))
         - length(replace(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1), '>', '')) AS level
  FROM l
), own AS (
  SELECT t.conv_id, t.n, t.turn, t.role, trim(coalesce(o.own, ''), ' ') AS own
  FROM t LEFT JOIN (SELECT conv_id, n, string_agg(body, chr(10) ORDER BY i) AS own FROM p WHERE level = 0 GROUP BY conv_id, n) o
    ON o.n = t.n AND o.conv_id IS NOT DISTINCT FROM t.conv_id
), c AS (
  SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY conv_id, n ORDER BY i) THEN 0 ELSE 1 END AS new FROM p
), g AS (
  SELECT *, sum(new) OVER (PARTITION BY conv_id, n ORDER BY i) AS run FROM c
), ps AS (
  SELECT conv_id, n, any_value(level) AS level, string_agg(body, chr(10) ORDER BY i) AS body,
         row_number() OVER (PARTITION BY conv_id, n ORDER BY run) AS k
  FROM g WHERE level > 0 GROUP BY conv_id, n, run
), nl AS (  -- normalised lines, of passages and of own texts
  SELECT conv_id, n, k, 'p' AS kind, generate_subscripts(string_split(body, chr(10)), 1) AS i, unnest(string_split(body, chr(10))) AS line FROM ps
  UNION ALL
  SELECT conv_id, n, 0, 'o', generate_subscripts(string_split(own, chr(10)), 1), unnest(string_split(own, chr(10))) FROM own
), nn AS (
  SELECT conv_id, n, k, kind, i, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
  FROM nl
), ls AS (
  SELECT conv_id, n, k, kind, list(line ORDER BY i) AS lines, array_to_string(list(line ORDER BY i), ' ') AS hash
  FROM nn WHERE line <> '' GROUP BY conv_id, n, k, kind
), q AS (
  SELECT ls.conv_id, ls.n, ls.k, ps.level, ls.hash, ls.lines
  FROM ls JOIN ps ON ls.kind = 'p' AND ps.n = ls.n AND ps.k = ls.k AND ps.conv_id IS NOT DISTINCT FROM ls.conv_id
), heads AS (
  SELECT DISTINCT lines[1] AS head, len(lines) AS size FROM q WHERE len(lines) > 1
), o AS (
  SELECT conv_id, n, hash FROM ls WHERE kind = 'o'
  UNION
  SELECT conv_id, n, line FROM nn WHERE kind = 'o' AND line <> ''
  UNION
  SELECT s.conv_id, s.n, array_to_string(s.lines[s.at:s.at + heads.size - 1], ' ')
  FROM (SELECT conv_id, n, lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS at FROM ls WHERE kind = 'o' AND len(lines) > 1) s
  JOIN heads ON heads.head = s.line AND s.at + heads.size - 1 <= len(s.lines)
), ix AS (
  SELECT o.* FROM o WHERE hash IN (SELECT hash FROM q)
), here AS (
  SELECT q.conv_id, q.n, q.k, max(ix.n) AS to_n FROM q JOIN ix ON ix.hash = q.hash AND ix.conv_id IS NOT DISTINCT FROM q.conv_id AND ix.n < q.n
  GROUP BY q.conv_id, q.n, q.k
), convs AS (
  SELECT hash, conv_id, row_number() OVER (PARTITION BY hash ORDER BY conv_id NULLS FIRST) AS r FROM (SELECT DISTINCT hash, conv_id FROM ix)
), there AS (
  SELECT DISTINCT q.conv_id, q.n, q.k FROM q JOIN convs ON convs.hash = q.hash AND convs.r <= 2 AND convs.conv_id IS DISTINCT FROM q.conv_id
), found AS (
  SELECT q.conv_id, q.n, q.k, q.level, here.to_n, there.n IS NOT NULL AS elsewhere
  FROM q LEFT JOIN here ON here.n = q.n AND here.k = q.k AND here.conv_id IS NOT DISTINCT FROM q.conv_id
  LEFT JOIN there ON there.n = q.n AND there.k = q.k AND there.conv_id IS NOT DISTINCT FROM q.conv_id
), links AS (
  SELECT conv_id, n, arg_min(to_n, (level, k)) FILTER (to_n IS NOT NULL) AS to_n, count(*) AS n_linked
  FROM found WHERE to_n IS NOT NULL OR elsewhere GROUP BY conv_id, n
), r AS (
  SELECT own.*, coalesce(links.to_n, CASE WHEN own.n > 1 THEN own.n - 1 END) AS reply_to, coalesce(links.n_linked, 0) AS n_linked
  FROM own LEFT JOIN links ON links.n = own.n AND links.conv_id IS NOT DISTINCT FROM own.conv_id
), th AS (
  SELECT *, max(CASE WHEN n = 1 OR reply_to < n - 1 THEN n END) OVER (PARTITION BY conv_id ORDER BY n) AS thread FROM r
), up AS (
  SELECT a.conv_id, a.n AS thread, b.thread AS parent
  FROM th a JOIN th b ON b.n = a.reply_to AND b.conv_id IS NOT DISTINCT FROM a.conv_id WHERE a.n > 1 AND a.reply_to < a.n - 1
), d AS (
  SELECT conv_id, 1 AS thread, 0 AS depth FROM th WHERE n = 1
  UNION ALL
  SELECT up.conv_id, up.thread, d.depth + 1 FROM d JOIN up ON up.parent = d.thread AND up.conv_id IS NOT DISTINCT FROM d.conv_id
), nq AS (
  SELECT conv_id, n, count(*) AS n_quotes FROM ps GROUP BY conv_id, n
)
SELECT th.conv_id, th.n, th.turn, th.role, th.reply_to, th.thread, d.depth, CAST(coalesce(nq.n_quotes, 0) AS BIGINT) AS n_quotes,
       CAST(th.n_linked AS BIGINT) AS n_linked, th.own AS text
FROM th JOIN d ON d.thread = th.thread AND d.conv_id IS NOT DISTINCT FROM th.conv_id
LEFT JOIN nq ON nq.n = th.n AND nq.conv_id IS NOT DISTINCT FROM th.conv_id
"""
