"""Chat formatting by event-sourced reconstruction, in DataFrame expressions only.

A log row is (conv_id, seq, message, kind, role, text): a ``delta`` appends its text to the message, an ``edit``
replaces what the message held, and a ``regenerate`` does so and discards every later message logged before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "###", "</turn>"


def escaped(text: Column) -> Column:
    """``text`` without control strings; after this every backslash is followed by one of the letters b, h, t, c."""
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(out, F.lit(OPEN), F.lit("\\h")), F.lit(CLOSE), F.lit("\\t"))


def unescaped(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\h"), F.lit(OPEN)), F.lit("\\t"), F.lit(CLOSE))
    return F.replace(F.replace(out, F.lit("\\c"), F.lit(":")), F.lit("\\b"), F.lit("\\"))


def messages(events: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: the final messages of each conversation in order, as (message, role, text).

    One shuffle by conversation; every window and both aggregations keep its partitioning. An event counts if no later
    regeneration of an earlier message and no later edit or regeneration of its own message wiped it out. Null text is
    empty, null role the empty role, a null conv_id is one conversation; events with one seq are ordered by role and
    text. A conversation's own messages meet in one task, since its formatted text is one value.
    """
    e = events.select("conv_id", F.col("seq").cast("long").alias("seq"), F.col("message").cast("long").alias("message"), "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    e = e.selectExpr("*", "max(case when kind = 'regenerate' then seq end) over (partition by conv_id order by message range between unbounded preceding and 1 preceding) as wiped", "max(case when kind in ('edit', 'regenerate') then seq end) over (partition by conv_id, message) as reset")
    e = e.where("(wiped is null or seq > wiped) and (reset is null or seq >= reset)")
    folded = e.groupBy("conv_id", "message").agg(F.max_by("role", F.struct("seq", "role")).alias("role"), F.expr("array_join(transform(array_sort(collect_list(struct(seq, role, text))), x -> x.text), '')").alias("text"))
    return folded.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("message", "role", "text"))).alias("turns"))


def formatted(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, loss_spans)`` from the result of ``messages``.

    A turn is ``### role: text</turn>`` and a line feed, with control strings inside roles and texts escaped.
    ``loss_spans`` holds (start, length) in code points of the texts of ``loss_role``, without marks.
    """
    parts = F.transform("turns", lambda t: F.struct(F.concat(F.lit(f"{OPEN} "), F.replace(escaped(t["role"]), F.lit(":"), F.lit("\\c")), F.lit(": ")).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss")))
    tail = len(CLOSE) + 1
    c = conversations.select("conv_id", parts.alias("parts"))
    c = c.withColumn("sizes", F.expr("transform(parts, p -> named_struct('head', cast(char_length(p.head) as long), 'body', cast(char_length(p.body) as long), 'loss', p.loss))"))
    spans = f"""aggregate(sizes, named_struct('at', 0L, 'spans', cast(array() as array<struct<start:bigint,length:bigint>>)),
        (a, s) -> named_struct('at', a.at + s.head + s.body + {tail}, 'spans', if(s.loss, array_append(a.spans, named_struct('start', a.at + s.head, 'length', s.body)), a.spans)), a -> a.spans)"""
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(f"{CLOSE}\n"))), "")
    return c.select("conv_id", text.alias("formatted"), F.expr(spans).alias("loss_spans"))


def read_back(output: DataFrame) -> DataFrame:
    """``(conv_id, turns, loss_text, formatted_chars)`` parsed from ``formatted`` alone: turns as (role, text)."""
    parts = F.split("formatted", f"{CLOSE}\n", -1)
    o = output.withColumn("parts", F.slice(parts, F.lit(1), F.size(parts) - 1))

    def turn(p: Column) -> Column:
        body = F.substring(p, F.lit(len(OPEN) + 2), F.char_length(p))
        role = F.substring_index(body, ": ", 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substring(body, F.char_length(role) + 3, F.char_length(p))).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    return o.select("conv_id", F.transform("parts", turn).alias("turns"), F.array_join(loss, "").alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))
