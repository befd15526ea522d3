"""Phrases of words that go together, mined by sampling and a check of the negative border.

Every part of a frequent phrase is frequent, so a phrase of k words need be counted only if both its parts of k - 1
words may be frequent.

1. All phrases of a sample of the documents (``SAMPLE`` of them, chosen by hash) are counted.  Those that occur often
   enough in it, under a support lowered for the sample, are proposed.
2. A pass over all documents counts the proposed phrases and their negative border exactly: every word, and every
   longer phrase whose two parts are proposed.
3. A phrase of the border that turns out frequent was missed by the sample.  Missed phrases are added to the proposed
   ones, and a further pass counts what they newly open.  Passes go on until no frequent phrase is missing, at most as
   many as a phrase has words, since each closes one more length.

The result does not depend on the sample; the sample only saves counting.  What is proposed is shipped to the tasks as
bit tables of fixed size (``BITS``): a false hit there only means that a phrase is counted in vain, and a phrase is
counted in the first pass whose tables open it and in no other.  Counts are sums of strings, not of hashes.

Counts are kept apart by language.  A task adds up its phrases before the shuffle.  The empty phrase is counted as well:
it occurs once a word, which gives the number of words of a language.

Defined cases: null text is empty, null language is ``und``; repeated rows count as often as they come; a text without
words gives nothing; an empty table gives an empty table; ids and other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from .textops import Ranges, byte_values, mix, packs, text_bytes

MIN_COUNT, LONGEST, TOP = 10, 3, 2000
#: Share of the documents in the sample (one in so many) and what lowers the support there.
SAMPLE, LOWERED = 8, 0.5
#: Bits of a table of proposed phrases (8 MB), and phrases a task adds up before it hands them on.
BITS, HELD = 1 << 26, 300_000
#: Language, number of words and phrase are one string in the shuffle, which costs less than three columns.
COUNTS, MARK = "key string, n long", "\x1f"

_CLEAN = bytearray(range(256))
_CLEAN[65:91] = range(97, 123)
_CLEAN[9] = 32
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _CLEAN[_c] = 10
_CLEAN = bytes(_CLEAN)


class Phrases:
    """Words of a pack of texts; one space is between words of a piece, line feeds are between pieces."""

    def __init__(self, texts: list[bytes], lang: bytes):
        buf = b"\n".join(t.translate(_CLEAN) for t in texts) + b"\n"
        while b"  " in buf:
            buf = buf.replace(b"  ", b" ")
        self.buf = buf
        view = np.frombuffer(buf, np.uint8)
        inside = (view != 32) & (view != 10)
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
        self.start, self.end = edge[::2], edge[1::2]
        self._hash = Ranges(byte_values(view), "byte")
        self._salt = _salt(lang)
        self._known: dict[int, np.ndarray] = {}
        self.next = np.zeros(len(self.start), bool)  # the next word follows in the same piece
        if len(self.start) > 1:
            self.next[:-1] = (self.start[1:] == self.end[:-1] + 1) & (view[self.end[:-1]] == 32)

    def hashes(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on, with the language; of no meaning where they are not in one piece."""
        if k not in self._known:
            n = max(0, len(self.start) - k + 1)
            self._known[k] = mix(self._hash.hash(self.start[:n], self.end[k - 1: k - 1 + n]) + self._salt)
        return self._known[k]


    def phrases(self, k: int, here: np.ndarray) -> list[bytes]:
        """The phrases of k words that begin at the marked words."""
        if k == 1 and here.all():
            return self.buf.split()
        at = np.flatnonzero(here)
        buf = self.buf
        return [buf[a:b] for a, b in zip(self.start[at].tolist(), self.end[at + k - 1].tolist())]


def _salt(lang: bytes) -> np.uint64:
    return Ranges(byte_values(np.frombuffer(lang, np.uint8)), "byte").hash(np.array([0]), np.array([len(lang)]))[0]


def _positions(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(BITS - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _hit(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _positions(hashes)
    bit = lambda x: (table[(x >> np.uint64(3)).view(np.int64)] >> (x & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    hit = bit(a)
    hit[hit] = bit(b[hit])
    return hit


def _opened(found: Phrases, tables: dict[int, np.ndarray] | None, longest: int) -> dict[int, np.ndarray]:
    """For each length, at which words a phrase begins whose two parts are in ``tables`` (all phrases if None)."""
    out = {1: np.ones(len(found.start), bool)}
    whole = np.ones(len(found.start), bool)
    for k in range(2, longest + 1):
        whole = whole[:-1] & found.next[k - 2: k - 2 + max(0, len(whole) - 1)]
        if tables is None:
            out[k] = whole
        else:
            part = _hit(tables[k - 1], found.hashes(k - 1))
            out[k] = whole & part[: len(whole)] & part[1: len(whole) + 1]
    return out


def count(docs: DataFrame, lang: Column, text: Column, now, before, longest: int) -> DataFrame:
    """``(lang, k, phrase, n)`` of the phrases that the tables ``now`` open and ``before`` did not.

    Both are broadcasts of tables by length, or None: without ``now`` every phrase is counted, without ``before``
    words and the empty phrase are counted too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[bytes, int], Counter] = {}
        held = 0
        for batch in batches:
            langs, texts = text_bytes(batch.column(0)), text_bytes(batch.column(1))
            # texts of one language side by side, each language a part of its own
            for tongue in sorted(set(langs)):
                some = [t for t, x in zip(texts, langs) if x == tongue]
                for a, b in packs(some):
                    found = Phrases(some[a:b], tongue)
                    opened = _opened(found, now and now.value, longest)
                    old = _opened(found, before.value, longest) if before else {}
                    for k, here in opened.items():
                        if k in old:
                            here = here & ~old[k]
                        phrases = found.phrases(k, here)
                        if phrases:
                            own = sums.setdefault((tongue, k), Counter())
                            held -= len(own)
                            own.update(phrases)
                            held += len(own)
                    if not before:
                        sums.setdefault((tongue, 0), Counter())[b""] += len(found.start)
                    if held > HELD:
                        yield from _rows(sums)
                        sums, held = {}, 0
        yield from _rows(sums)

    table = docs.select(F.coalesce(lang.cast("string"), F.lit("und")).alias("lang"), text.alias("t"))
    sums = table.mapInArrow(run, COUNTS).groupBy("key").agg(F.sum("n").alias("n"))
    # <words>\x1f<length of the language>\x1f<language><phrase>: a language may hold any character
    k, rest = F.substring_index("key", MARK, 1), F.expr(f"substring(key, locate('{MARK}', key) + 1)")
    split = sums.select(k.cast("int").alias("k"), rest.alias("r"), "n").select(
        "k", F.substring_index("r", MARK, 1).cast("int").alias("m"), F.expr(f"substring(r, locate('{MARK}', r) + 1)").alias("r"), "n")
    return split.select(F.expr("left(r, m)").alias("lang"), "k", F.expr("substring(r, m + 1)").alias("phrase"), "n")


def _rows(sums: dict[tuple[bytes, int], Counter]) -> Iterator[pa.RecordBatch]:
    for (tongue, k), own in sums.items():
        head, words = f"{k}{MARK}{len(tongue.decode('utf-8', 'replace'))}{MARK}".encode() + tongue, list(own)
        for i in range(0, len(words), 100_000):
            part = words[i: i + 100_000]
            keys = pc.binary_join_element_wise(pa.scalar(head), pa.array(part, pa.binary()), pa.scalar(b""))
            yield pa.RecordBatch.from_arrays([keys.cast(pa.string(), safe=False), pa.array([own[x] for x in part], pa.int64())], names=["key", "n"])


def _tables(proposed: DataFrame, longest: int) -> dict[int, np.ndarray]:
    """Bit tables of the proposed phrases of 1 to ``longest`` - 1 words; ``BITS`` bits each, however many phrases."""
    block = 1 << 16

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tongues, phrases, ks = text_bytes(batch.column(0)), text_bytes(batch.column(2)), batch.column(1).to_numpy()
            ends = np.cumsum([0, *map(len, phrases)])
            ranges = Ranges(byte_values(np.frombuffer(b"".join(phrases), np.uint8)), "byte")
            salts = {x: _salt(x) for x in set(tongues)}
            hashes = mix(ranges.hash(ends[:-1], ends[1:]) + np.array([salts[x] for x in tongues], np.uint64))
            where = np.concatenate(_positions(hashes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(ks, 2)), pa.array(where // block), pa.array((where % block).astype(np.int32))],
                                             names=["k", "block", "bit"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for found in batch.column("bits"):
                flags = np.zeros(block, np.uint8)
                flags[found.values.to_numpy()] = 1
                packed.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("block"), pa.array(packed, pa.binary())], names=["k", "block", "bits"])

    made = (proposed.where(F.col("k").between(1, longest - 1)).select("lang", "k", "phrase").mapInArrow(bits, "k int, block long, bit int")
            .groupBy("k", "block").agg(F.collect_set("bit").alias("bits")).mapInArrow(join, "k int, block long, bits binary"))
    out = {k: np.zeros(BITS // 8, np.uint8) for k in range(1, longest)}
    for r in made.collect():  # at most BITS / 8 bytes for each length
        at = r["block"] * block // 8
        out[r["k"]][at: at + block // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, sample: int = SAMPLE, lang_col: str = "lang",
             text_col: str = "text") -> tuple[DataFrame, int]:
    """``(lang, k, phrase, n)`` of all phrases of 0 to ``longest`` words that occur ``min_count`` times or more in a
    language, the empty phrase whatever its count; and the number of passes over all documents."""
    spark = docs.sparkSession
    lang, text = F.col(lang_col), F.col(text_col)
    part = docs.where(F.pmod(F.xxhash64(text), F.lit(sample)) == 0)
    support = max(2, int(LOWERED * min_count / sample))
    proposed = cut(count(part, lang, text, None, None, longest).where((F.col("k").between(1, longest - 1)) & (F.col("n") >= support))
                   .select("lang", "k", "phrase"))
    now, before, known, passes = spark.sparkContext.broadcast(_tables(proposed, longest)), None, None, 0
    while True:
        counted = count(docs, lang, text, now, before, longest)
        new = cut(counted.where((F.col("n") >= min_count) | (F.col("k") == 0)))
        passes += 1
        known = new if known is None else known.unionByName(new)
        missed = cut(new.where(F.col("k").between(1, longest - 1)).join(proposed, ["lang", "k", "phrase"], "left_anti").select("lang", "k", "phrase"))
        if missed.isEmpty():
            return known, passes
        proposed = proposed.unionByName(missed)
        opened = _tables(missed, longest)
        wider = {k: now.value[k] | opened[k] for k in opened}
        if before:
            before.unpersist()
        before, now = now, spark.sparkContext.broadcast(wider)


def _first(phrase: str, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def _rest(phrase: str, k: int) -> Column:
    """The words behind the first k."""
    return F.expr(f"substring({phrase}, length(substring_index({phrase}, ' ', {k})) + 2)")


def score(known: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``(lang, k, phrase, a, l, r, n, score, dropped)`` of the phrases of two words or more in a table of counts."""
    part = known.where("k > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    long = known.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    cuts = []
    for k in range(2, longest + 1):
        own = long.where(F.col("k") == k)
        for at in range(1, k):
            cuts.append(own.select("lang", "k", "phrase", "a", F.lit(at).alias("at"), _first("phrase", at).alias("left"), _rest("phrase", at).alias("right")))
    every = cuts[0]
    for more in cuts[1:]:
        every = every.unionByName(more)
    every = (every.join(part.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
             .join(part.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    # exact: counts below 1e15 make products below 1e38, and no part is rarer than the whole, so a score is at most 10 ** 6
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    every = every.withColumn("top", (wide("a") * wide("a")).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)"))
    every = every.withColumn("bottom", (wide("l") * wide("r")).cast("decimal(32,0)"))
    every = every.withColumn("score", F.expr("cast(top as decimal(38,0)) div bottom"))
    least = F.min(F.struct("score", "at", "l", "r"))
    scored = every.groupBy("lang", "k", "phrase", "a").agg(least.alias("m")).select("lang", "k", "phrase", "a", "m.l", "m.r", "m.score")
    inner = None
    for k in range(3, longest + 1):
        for size in range(2, k):
            for at in range(k - size + 1):
                words = F.split("phrase", " ")
                one = long.where(F.col("k") == k).select("lang", F.array_join(F.slice(words, at + 1, size), " ").alias("phrase"), F.col("a").alias("f"))
                inner = one if inner is None else inner.unionByName(one)
    if inner is None:
        scored = scored.withColumn("dropped", F.lit(False))
    else:
        longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
        scored = (scored.join(longer, ["lang", "phrase"], "left")
                  .withColumn("dropped", F.coalesce(100 * F.col("f") >= 50 * F.col("a"), F.lit(False))).drop("f"))
    words = known.where("k = 0").select("lang", "n")
    return scored.join(words, "lang")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, sample: int = SAMPLE, lang_col: str = "lang",
         text_col: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``."""
    known, _ = frequent(docs, min_count, longest, sample, lang_col, text_col)
    left = score(known, longest).where("not dropped")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first among the phrases of one hash, so that no task sees all phrases of a language
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = (left.withColumn("_salt", salt).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best)))
            .where(F.col("_r") <= top).drop("_salt", "_r"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    long = lambda c: F.col(c).cast("long").alias(c)
    return ranked.select("lang", long("rank"), "phrase", *map(long, ("a", "l", "r", "n", "score")))


#: The same phrases by counting all of them.
ORACLE = r"""
with p as (select lang, row_number() over () pid, piece from (select coalesce(lang, 'und') lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents)),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') ws from p),
g as (select lang, k, array_to_string(ws[i: i + k - 1], ' ') phrase from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) i
      from w, (values (1), (2), (3)) t(k))),
f as (select lang, k, phrase, count(*) c from g group by all),
n as (select lang, sum(c) n from f where k = 1 group by lang),
cand as (select * from f where k > 1 and c >= 10),
cuts as (select lang, k, phrase, c, cp, array_to_string(string_split(phrase, ' ')[1: cp], ' ') a1, array_to_string(string_split(phrase, ' ')[cp + 1:], ' ') a2
         from cand, (values (1), (2)) t(cp) where cp < k),
s as (select cuts.*, x.c l, y.c r, cast(1000000 as hugeint) * cuts.c * cuts.c // (cast(x.c as hugeint) * y.c) score
      from cuts join f x on x.lang = cuts.lang and x.phrase = a1 join f y on y.lang = cuts.lang and y.phrase = a2),
m as (select * from s qualify row_number() over (partition by lang, phrase order by score, cp) = 1),
longer as (select lang, array_to_string(string_split(phrase, ' ')[i: i + 1], ' ') phrase, max(c) c from cand, (values (1), (2)) t(i) where k = 3 group by 1, 2),
kept as (select m.* from m left join longer on longer.lang = m.lang and longer.phrase = m.phrase where not coalesce(100 * longer.c >= 50 * m.c, false)),
r as (select kept.lang, row_number() over (partition by kept.lang order by score desc, c desc, phrase) rank, phrase, c a, l, r, n.n, score
      from kept join n on n.lang = kept.lang)
select lang, cast(rank as bigint) rank, phrase, cast(a as bigint) a, cast(l as bigint) l, cast(r as bigint) r, cast(n as bigint) n,
       cast(score as bigint) score from r where rank <= 2000"""
