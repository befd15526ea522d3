"""Phrase mining against counting everything."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tissueframe.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, k int, a int, rank int"


def rows():
    rng = random.Random(12)
    words = ["new", "York", "city", "of", "the", "x", "é", "À", "tab\tbed", "don't", "a b", "\x1f", "-"] + [f"w{i}" for i in range(12)]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " ;", "\x0b", "\r\n", " . "]
    say = lambda n: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))
    texts = [None, "", " \t", ".,;:!?\n", "one", "aa aa aa aa aa", "AA aa\taa  aa"] + [say(rng.randint(1, 80)) for _ in range(60)]
    texts += [say(8) + " New York City " + say(8) for _ in range(12)] + ["long " * 30_000, say(30_000)]
    langs = ["en", "fr", None, "und", ""]
    out = [(i, t, langs[i % 5], "p", 1, 2, 3, 4) for i, t in enumerate(texts)]
    return [*out, out[9], out[9], (None, say(50), "en", "p", 1, 2, 3, 4), (4, say(50), "fr", "p", 1, 2, 3, 4)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4).cache()


def brute(data, min_count, longest, top):
    f = defaultdict(Counter)
    n = Counter()
    for r in data:
        lang = "und" if r[2] is None else r[2]
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        good = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        found = []
        for p, a in good.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in good.items()):
                continue
            score, _, lo, r = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), lo, r))
        for rank, (s, a, p, lo, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, lo, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize(("sample", "longest", "top", "passes"), [(1, 3, 2000, 1), (8, 3, 5, None), (1_000_003, 3, 2000, 3), (1_000_003, 4, 2000, 4)])
def test_equals_counting_everything(spark, docs, sample, longest, top, passes):
    """The sample only decides how many passes it takes: all rows need one, an empty sample one for each length."""
    got = sorted(map(tuple, collocations.mine(docs, 5, longest, top, sample).collect()))
    assert got == brute(rows(), 5, longest, top) and len(got) >= 15
    if passes:
        assert collocations.frequent(docs, 5, longest, sample)[1] == passes


def test_a_missed_phrase_of_the_border_opens_another_pass(spark):
    data = [(i, "alpha beta gamma" if i < 40 else f"filler{i} text{i}", "en") for i in range(80)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string")
    known, passes = collocations.frequent(frame, 10, 3, sample=1_000_003)
    assert passes == 3 and {r["phrase"]: r["n"] for r in known.where("k > 1").collect()} == {"alpha beta": 40, "beta gamma": 40, "alpha beta gamma": 40}
    known, passes = collocations.frequent(frame, 10, 3, sample=1)
    assert passes == 1 and known.where("k > 1").count() == 3


def test_products_beyond_64_bits_are_exact(spark):
    big = 4_000_000_000_000
    known = spark.createDataFrame([("en", 0, "", 9 * big), ("en", 1, "a", big + 1), ("en", 1, "b", big + 3), ("en", 2, "a b", big - 7)],
                                  "lang string, k int, phrase string, n long")
    r = collocations.score(known).first()
    assert r["score"] == 1_000_000 * (big - 7) ** 2 // ((big + 1) * (big + 3)) and (r["l"], r["r"], r["n"]) == (big + 1, big + 3, 9 * big)


def test_full_bit_tables_change_nothing(spark, docs, monkeypatch):
    monkeypatch.setattr(collocations, "_tables", lambda p, longest: {k: np.full(collocations.BITS // 8, 255, np.uint8) for k in range(1, longest)})
    assert sorted(map(tuple, collocations.mine(docs, 5, 3, 2000, 8).collect())) == brute(rows(), 5, 3, 2000)


def test_empty_and_wordless(spark, docs):
    assert collocations.mine(docs.limit(0)).count() == 0
    assert collocations.mine(docs.where("text is null or text = ''")).count() == 0


@pytest.mark.parametrize("held", [1, 400])
def test_sums_handed_on_early_change_nothing(spark, docs, monkeypatch, held):
    """Tasks that hold few phrases hand the same ones on many times."""
    monkeypatch.setattr(collocations, "HELD", held)
    parts = docs.mapInArrow(lambda batches: (part for b in batches for part in (b.slice(0, 9), b.slice(9))), docs.schema)
    got = sorted(map(tuple, collocations.mine(parts, 5).collect()))
    assert got == brute(rows(), 5, 3, 2000)
