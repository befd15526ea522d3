"""Mixing of sources to target weights, with DataFrame and SQL functions only.

1. The words of a source form one stream (documents in a fixed order) that is packed into blocks of ``BLOCK`` words.
2. A source's target is turned into slots of one block.  All slots are put in random order and dealt to output shards,
   so a shard's counts by source are a multinomial draw, conditioned on the totals being the targets.
3. A source's slots go round its blocks in a pseudorandom order of their indices, each block once before any twice.
4. Slots and blocks are joined by index; a block says which words of which documents it holds.

Both orders are swap-or-not permutations of 0..n-1, computed from the index alone: nothing is sorted or gathered by
source, and a rerun gives the same mix.  Positions within a source are sums over ``CHUNKS`` chunks and then inside a
chunk, so a source with a third of all rows is as many tasks.

Defined cases: null or blank text has no words and is never taken; a null source is the last source; repeated rows
are documents of their own; with no words at all targets are 0; other columns are kept out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut

BLOCK, CHUNKS, SHARD, ROUNDS = 32, 4096, 65_536, 16
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Separators between words.
_SPACE = " \\t\\n\\u000B\\f\\r"


def words(text: Column) -> Column:
    """Words between runs of ASCII white space; null or blank: none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def permuted(index: Column, n: Column, *seed: Column) -> Column:
    """Image of ``index`` under a permutation of 0..n-1: each round pairs k - x with x and swaps by a hash of the pair."""

    def step(x: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(i, *seed), n) - x, n)
        swap = F.xxhash64(F.greatest(x, other), i, *seed).bitwiseAND(1) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), step)


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Weights repeat over the sources in order of code points, null last.  Sources at their cap keep it and the rest
    share what is left by weight: target = min(cap, level * weight), where the level is the largest of the levels that
    follow if the sources with the smallest cap by weight are at their cap.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (rank % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * MOST
    ranked = cut(totals.select("source", "source_size", rank.cast("int").alias("sid"), weight.alias("w"), cap.alias("cap")))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("cap") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    capped, spent = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * SHARE - capped) / (F.sum("w").over(everything) - spent)
    return (ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
            .select("source", "sid", "source_size", F.greatest(F.lit(0.0), F.least("cap", F.col("level") * F.col("w"))).alias("target")))


def place(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``(doc_id, tag, source, size, start)``: where each document starts in the stream of its source."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("tag"),
                       F.size(words(F.col(text_col))).cast("long").alias("size"))
    base = cut(base.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "tag"), F.lit(CHUNKS))))
    chunk = base.groupBy("source", "chunk").agg(F.sum("size").alias("n"))
    upto = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    heads = chunk.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("head"))
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "tag").rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(heads, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c"))).select(
        "doc_id", "tag", "source", "size", (F.col("head") + F.col("inner")).alias("start"))


def _each(rows: DataFrame, count: str, name: str, step: int = SHARD, steps: int = 4) -> DataFrame:
    """A row for each number below ``count``; large counts are dealt to many tasks before they are spelled out."""
    many = cut(rows.where(F.col(count) > 0).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.lit(step).cast("long")))))
    tasks = min(200_000, many.count() // steps + 1)
    return (many.repartition(tasks, "sid", "_from")
            .withColumn(name, F.explode(F.sequence(F.col("_from"), F.least(F.col(count), F.col("_from") + step) - 1))).drop("_from"))


def mix(placed: DataFrame, plan: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = 1) -> DataFrame:
    """The mix: ``(shard, slot, sid, block, epoch, start, first, length)``, ordered by shard and slot.

    ``start`` names the document of the source's stream, ``first`` and ``length`` its words that the slot takes.
    """
    key = F.lit(seed)
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    wanted = F.when(F.col("source_size") > 0, F.least(blocks * MOST, F.round(F.col("target") * blocks / F.col("source_size")).cast("long"))).otherwise(0)
    counted = plan.select("sid", "source", "source_size", blocks.alias("blocks"), wanted.cast("long").alias("slots"))
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = cut(counted.withColumn("before", F.coalesce(F.sum("slots").over(upto), F.lit(0)))
                  .withColumn("all", F.sum("slots").over(everything)))
    slots = _each(counted, "slots", "r")
    slot = permuted(F.col("before") + F.col("r"), F.col("all"), key)
    slots = slots.select("sid", permuted(F.col("r") % F.col("blocks"), F.col("blocks"), key, F.col("sid")).alias("block"),
                         F.floor(F.col("r") / F.col("blocks")).alias("epoch"), slot.alias("slot"))
    named = counted.select("sid", F.col("source").alias("s"))
    spans = (placed.where("size > 0").join(named, F.col("source").eqNullSafe(F.col("s")))
             .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))))
    low = F.greatest(F.col("start"), F.col("block") * block)
    spans = spans.select("sid", "block", "start", (low - F.col("start")).alias("first"),
                         (F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - low).alias("length"))
    # spelled-out rows look smaller to the planner than they are: never broadcast them
    return slots.join(spans.hint("merge"), ["sid", "block"]).select(
        F.floor(F.col("slot") / shard).alias("shard"), "slot", "sid", "block", "epoch", "start", "first", "length")


def taken(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for each row of ``docs``."""
    placed = cut(place(docs, id_col, source_col, text_col))
    plan = cut(targets(placed))
    used = mix(placed, plan).groupBy("sid", "start").agg(F.sum("length").alias("taken"))
    used = used.withColumn("some", F.lit(True))
    sized = plan.select(F.col("source").alias("s"), "sid", "source_size", "target")
    rows = placed.join(sized, F.col("source").eqNullSafe(F.col("s"))).withColumn("some", F.col("size") > 0)
    return rows.join(used.hint("merge"), ["sid", "start", "some"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix as rows of ``docs``: for each round over the blocks, a document's words taken in that round.

    The words keep their order and are joined by one space; a document taken in two rounds is two rows, one not taken
    at all is gone.  All columns of ``docs`` are kept.
    """
    placed = cut(place(docs, id_col, source_col, text_col))
    plan = cut(targets(placed))
    ranges = mix(placed, plan).groupBy("sid", "start", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("first", "length"))).alias("ranges"))
    named = plan.select("sid", F.col("source").alias("s"))
    rows = (placed.where("size > 0").join(named, F.col("source").eqNullSafe(F.col("s")))
            .join(ranges.hint("merge"), ["sid", "start"]).select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), "start", "epoch", "ranges"))
    numbered = Window.partitionBy("__id", "__tag", "epoch").orderBy("start")
    rows = rows.withColumn("__copy", F.row_number().over(numbered))
    same = Window.partitionBy(id_col, "__tag").orderBy("__tag")
    tagged = docs.withColumn("__tag", F.xxhash64(text_col)).withColumn("__copy", F.row_number().over(same))
    joined = tagged.alias("d").join(rows.alias("r").hint("merge"), F.col(f"d.{id_col}").eqNullSafe(F.col("r.__id"))
                                    & (F.col("d.__tag") == F.col("r.__tag")) & (F.col("d.__copy") == F.col("r.__copy")))
    # the words are a variable of the outer function, so they are split once and not for each range
    part = F.element_at(F.transform(F.array(words(F.col(f"d.{text_col}"))), lambda w: F.array_join(F.flatten(F.transform(
        F.col("ranges"), lambda x: F.slice(w, (x["first"] + 1).cast("int"), x["length"].cast("int")))), " ")), 1)
    return joined.select(*[part.alias(c) if c == text_col else F.col(f"d.{c}") for c in docs.columns])
