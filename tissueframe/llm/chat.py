"""Multi-party perspective rotation, with DataFrame and SQL functions only.

For every participant of a conversation the dialogue is rendered once with that speaker as assistant and all others as
named users; the mask marks the characters that the assistant produces, the only ones to learn from.  System messages
are shown to everybody and belong to nobody.

A dialogue is written in parts of ``PART`` turns (by turn number), so the text of a part is bounded however long the
conversation is; most conversations are one part, and the parts in order are the dialogue.

Defined cases: a null role is the participant ``unknown``; null text is an empty message; a null conversation id is one
conversation; a null turn comes first, in part 0; rows that repeat conversation, turn, role and text are one message;
different messages of one turn are ordered by role and text; a conversation of system messages only has no participant
and no row.  Marker characters inside texts and names are broken up, so a text cannot open a message.  Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PART = 64
SYSTEM, UNKNOWN = "system", "unknown"
OPEN, CLOSE = "<|start|>", "<|end|>\n"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate(messages: DataFrame, part: int = PART) -> DataFrame:
    """``(conv_id, speaker, part, n_messages, text, mask)`` from ``(conv_id, turn, role, text)``.

    ``mask`` lists the character ranges ``from:to`` (from 0, end exclusive) of the speaker's own messages, their closing
    marker included, separated by commas.
    """
    unique = messages.select("conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    speakers = unique.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    seen = unique.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))
    own = F.col("role") == F.col("speaker")
    header = (F.when(own, "assistant").when(F.col("role") == SYSTEM, "system")
              .otherwise(F.concat(F.lit("user name="), _plain(F.col("role")))))
    head = F.concat(F.lit(OPEN), header, F.lit("\n"))
    body = F.concat(_plain(F.col("text")), F.lit(CLOSE))
    number = F.coalesce(F.floor(F.col("turn") / part), F.lit(0))
    parts = seen.select("conv_id", "speaker", number.cast("long").alias("part"), F.struct(
        "turn", "role", "text", F.concat(head, body).alias("shown"), F.length(head).alias("head"),
        (F.length(head) + F.length(body)).alias("size"), own.alias("own")).alias("m"))
    rows = parts.groupBy("conv_id", "speaker", "part").agg(F.sort_array(F.collect_list("m")).alias("ms"))

    def advance(state: Column, m: Column) -> Column:
        span = F.concat((state["at"] + m["head"]).cast("string"), F.lit(":"), (state["at"] + m["size"]).cast("string"))
        return F.struct((state["at"] + m["size"]).alias("at"),
                        F.when(m["own"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    mask = F.aggregate("ms", begin, advance, lambda state: F.array_join(state["spans"], ","))
    return rows.select("conv_id", "speaker", "part", F.size("ms").cast("long").alias("n_messages"),
                       F.array_join(F.transform("ms", lambda m: m["shown"]), "").alias("text"), mask.alias("mask"))


#: The same in DuckDB.
ORACLE = f"""
    with u as (select distinct conv_id, turn, coalesce(role, '{UNKNOWN}') as role, coalesce(text, '') as text from conversations),
    s as (select distinct conv_id, role as speaker from u where role <> '{SYSTEM}'),
    m as (select u.conv_id, s.speaker, u.turn, u.role, u.text, u.role = s.speaker own,
                 cast(coalesce(floor(u.turn / {PART}), 0) as bigint) part,
                 '{OPEN}' || case when u.role = s.speaker then 'assistant' when u.role = '{SYSTEM}' then 'system'
                                  else 'user name=' || replace(u.role, '<|', '< |') end || chr(10) head,
                 replace(u.text, '<|', '< |') || '{CLOSE.strip()}' || chr(10) body
          from u join s on u.conv_id is not distinct from s.conv_id),
    o as (select *, coalesce(sum(length(head) + length(body)) over (
                 partition by conv_id, speaker, part order by turn nulls first, role, text rows between unbounded preceding and 1 preceding), 0) pos
          from m)
    select conv_id, speaker, part, count(*) n_messages, string_agg(head || body, '' order by turn nulls first, role, text) as text,
           coalesce(string_agg(case when own then cast(pos + length(head) as bigint) || ':' || cast(pos + length(head) + length(body) as bigint) end,
                               ',' order by turn nulls first, role, text), '') mask
    from o group by conv_id, speaker, part"""
