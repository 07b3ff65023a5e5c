"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is its turns one after the other. A turn is ``[INST] text [/INST]`` (user), ``<s> text </s>`` (assistant),
``[SYS] text [/SYS]`` (system) or ``[TURN=hex] text [/TURN]`` (any other role, as hex of its UTF-8). Control strings
inside a text get a backslash after their first character, one more if they have some; taking one away undoes that.
Each turn is rendered as it is, parsed, and compared with its source; where that differs, or a control string stands in the text, the text is escaped
and rendered again. As turns parse back alone and no turn reaches over its closing mark, so does a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of each role.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER = ("[TURN=", "] ", " [/TURN]")
CONTROL = r"(/?s>|/?INST\]|/?SYS\]|TURN=|/TURN\])"
BARE = rf"[<\[]{CONTROL}"
TURN = r"(?s)\[INST\] .*? \[/INST\]|<s> .*? </s>|\[SYS\] .*? \[/SYS\]|\[TURN=[0-9A-F]*\] .*? \[/TURN\]"
PROBE_ID = -1
PROBE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL}", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){CONTROL}", r"$1$2$3")


def render(role: Column, body: Column) -> Column:
    shown = F.concat(F.lit(OTHER[0]), F.hex(F.encode(role, "utf-8")), F.lit(OTHER[1]), body, F.lit(OTHER[2]))
    for name, (opening, closing) in MARKS.items():
        shown = F.when(role == name, F.concat(F.lit(opening), body, F.lit(closing))).otherwise(shown)
    return shown


def _between(segment: Column, opening: Column | int, closing: str) -> Column:
    return F.substring(segment, opening + F.lit(1), F.length(segment) - opening - len(closing))


def read_turn(segment: Column) -> Column:
    """``role, body`` of one turn's text; the body as it stands there."""
    named = F.instr(segment, "]")
    role = F.decode(F.unhex(F.substring(segment, F.lit(len(OTHER[0]) + 1), named - len(OTHER[0]) - 1)), "utf-8")
    turn = F.struct(role.alias("role"), _between(segment, named + 1, OTHER[2]).alias("body"))
    for name, (opening, closing) in MARKS.items():
        known = F.struct(F.lit(name).alias("role"), _between(segment, F.lit(len(opening)), closing).alias("body"))
        turn = F.when(segment.startswith(opening), known).otherwise(turn)
    return turn


def segments(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TURN), F.lit(0))


def _reads_back(shown: Column, role: Column, text: Column) -> Column:
    """Whether a rendered turn parses as one turn with this role and text and no bare control string in its body."""
    read = segments(shown)
    back = read_turn(F.get(read, F.lit(0)))
    return (F.size(read) == 1) & (back["role"] == role) & (unescape(back["body"]) == text) & ~back["body"].rlike(BARE)


def settle_turn(role: Column, text: Column) -> Column:
    """The turn as it is if that parses back to its source without a bare control string in it, else escaped.

    The escaped turn is parsed and compared as well; one that does not read back is an error. Each comparison is a function over a
    list of one, so its parser stays out of the code that is generated for the stage.
    """
    plain, escaped = render(role, text), render(role, escape(text))
    failed = F.raise_error(F.concat(F.lit("a turn does not read back, role "), role)).cast("string")

    def holds(shown: Column) -> Column:
        return F.exists(F.array(shown), lambda s: _reads_back(s, role, text))

    return F.when(holds(plain), plain).when(holds(escaped), escaped).otherwise(failed)


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``formatted``, ``parsed`` (role and text of each turn, read back from it) and ``loss_spans``.

    Turns go by number, then role, then text; null numbers come first, and repeated turns all stay. Null roles and texts are empty; a null
    ``conv_id`` is a conversation of its own. ``loss_spans`` are the start (in code points from 0) and length of every
    assistant text inside ``formatted``, as it stands there. A conversation is one text and so one row. Other columns are not read. No rows give no rows.
    """
    clean = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shown = clean.withColumn("shown", settle_turn(F.col("role"), F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = shown.withColumn("at", F.coalesce(F.sum(F.length("shown")).over(order), F.lit(0)))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "turn", "role", "shown"))).alias("turns"))
    opening, closing = (len(mark) for mark in MARKS["assistant"])
    spans = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: F.struct(
        (t["at"] + opening).alias("start"), (F.length(t["shown"]) - opening - closing).alias("length")))
    joined = whole.select("conv_id", F.array_join(F.col("turns.shown"), "").alias("formatted"), spans.alias("loss_spans"))
    read = F.transform(segments(F.col("formatted")), read_turn)
    parsed = F.transform(read, lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text")))
    return joined.withColumn("parsed", parsed).select("conv_id", "formatted", "parsed", "loss_spans")


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and one more conversation whose two texts are made of control strings."""
    rows = turns.sparkSession.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(rows)


def digests(formatted: DataFrame) -> DataFrame:
    """What ``formatted`` says, in numbers and hashes: turns from the parsed text, losses from the spans of the mask, unescaped."""
    lines = F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"]))), "")
    return formatted.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), shown AS (
    SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|TURN=|/TURN\])', '\1\2\\\3', 'g'))
        + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 13 ELSE 16 + 2 * octet_length(encode(role)) END AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""
