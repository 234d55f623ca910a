"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar: conversation := turn*, turn := OPEN role MID content CLOSE; neither role nor content may
hold a control string. Each turn is first rendered as it stands and parsed back; where the parser
rejects it or reads something else, it is escaped: a backslash doubles, and a control string gets a
backslash after its first character. The parser drops one backslash before any character. Whole
conversations are then parsed once more and compared with their source; a difference is an error.

Defined cases: null role or text is empty; turns go by turn number (null first), then role, then
text; repeated rows are turns of their own; a null conversation id is one conversation; an empty
table gives no rows; other columns are ignored. A conversation is one output string, so all its
turns meet in one row by definition.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm._common import quoted

OPEN, MID, CLOSE = "[INST]", "[/INST]", "</s>"
CONTROL = (OPEN, MID, CLOSE)


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MID), text, F.lit(CLOSE))


def parse_body(body: Column) -> Column:
    """struct(role, text) of a turn without its CLOSE; null where it isn't one."""
    rest = F.substr(body, F.lit(len(OPEN) + 1))
    parts = F.split(rest, re.escape(MID), -1)
    good = F.startswith(body, F.lit(OPEN)) & ~F.contains(rest, F.lit(OPEN)) & (F.size(parts) == 2)
    return F.when(good, F.struct(unescape(parts[0]).alias("role"), unescape(parts[1]).alias("text")))


def parse(formatted: Column) -> Column:
    """array<struct(role, text)> of a formatted conversation; null where its end is open, null elements where a turn is broken."""
    bodies = F.split(formatted, re.escape(CLOSE), -1)
    n = F.size(bodies) - 1
    return F.when(F.element_at(bodies, -1) == "", F.transform(F.slice(bodies, F.lit(1), n), parse_body))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: formatted text, turns read back from it, and the loss mask: for each turn the (start, end) code points in it that are trained on, an empty part where the turn isn't."""
    empty = F.lit("")
    turns = rows.select(F.col(quoted(conv_col)).alias(conv_col), F.col(quoted(turn_col)).alias("turn"), F.coalesce(F.col(quoted(role_col)), empty).alias("role"), F.coalesce(F.col(quoted(text_col)), empty).alias("text"))
    raw = render(F.col("role"), F.col("text"))
    same = F.coalesce((F.size(parse(raw)) == 1) & (parse(raw)[0] == F.struct("role", "text")), F.lit(False))
    turns = turns.withColumn("rendered", F.when(same, raw).otherwise(render(escape(F.col("role")), escape(F.col("text")))))
    order = Window.partitionBy(conv_col).orderBy("turn", "role", "text")
    ended = F.sum(F.length("rendered")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    turns = turns.select("*", F.row_number().over(order).alias("place"), (ended - len(CLOSE)).alias("end"))
    grouped = turns.groupBy(conv_col).agg(F.sort_array(F.collect_list(F.struct("place", "role", "text", "rendered", "end"))).alias("own"))
    formatted = grouped.select(
        conv_col,
        F.array_join(F.transform("own", lambda x: x.rendered), "").alias("formatted"),
        F.transform("own", lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))).alias("source"),
        F.transform("own", lambda x: x.end).alias("ends"),
        F.transform("own", lambda x: F.struct(F.when(x.role == trained_role, x.end - F.length(x.rendered) + len(CLOSE) + F.instr(x.rendered, MID) - 1 + len(MID)).otherwise(x.end).alias("start"), x.end.alias("end"))).alias("loss_mask"),
    )
    # The mask's places are proven against the formatted text: turns must end where its control strings stand.
    before = F.concat(F.array(F.lit(-len(CLOSE)).cast("long")), F.slice("ends", F.lit(1), F.size("ends") - 1))
    lengths = F.zip_with("ends", before, lambda now, last: (now - last - len(CLOSE)).cast("int"))
    bodies = F.split("formatted", re.escape(CLOSE), -1)
    proven = F.transform(F.slice(bodies, F.lit(1), F.size(bodies) - 1), F.length) == lengths
    checked = formatted.withColumn("turns", parse(F.col("formatted")))
    return checked.select(conv_col, "formatted", F.when((F.col("turns") == F.col("source")) & proven, F.col("turns")).otherwise(F.raise_error(F.lit("a formatted conversation does not parse back"))).alias("turns"), "loss_mask")


def masked(formatted: Column, loss_mask: Column) -> Column:
    """All text of `formatted` under the mask, unescaped. A part of the mask ends with its turn's body, so it is cut from that body's end: linear in the text."""
    bodies = F.split(formatted, re.escape(CLOSE), -1)
    return F.array_join(F.zip_with(F.slice(bodies, F.lit(1), F.size(bodies) - 1), loss_mask, lambda body, m: unescape(F.right(body, (m.end - m.start).cast("int")))), "")


def digest(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and hashes of what the parser reads back, and of the formatted text under the loss mask."""
    spoken = F.array_join(F.transform("turns", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))), "")
    loss = masked(F.col("formatted"), F.col("loss_mask"))
    return formatted.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_matches(role || chr(0) || text, '(?s)\\[^\x00]') OR contains(role, '[INST]') OR contains(role, '[/INST]') OR contains(role, '</s>')
    OR contains(text, '[INST]') OR contains(text, '[/INST]') OR contains(text, '</s>') AS hit
  FROM turns
), sized AS (
  SELECT *, 17 + CASE WHEN hit
    THEN length(replace(replace(replace(replace(role, '\', '\\'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '</s>', '<\/s>'))
       + length(replace(replace(replace(replace(text, '\', '\\'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '</s>', '<\/s>'))
    ELSE length(role) + length(text) END AS chars
  FROM marked
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
