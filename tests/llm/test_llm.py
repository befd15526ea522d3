"""Operators of the training-data package against brute force, on rows with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from tissueframe.llm import (chat, language_id, license_scan, mixing, packing, quality, simhash, substring_dedup, topk, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, tag string, fp int, start int, key string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def rows():
    rng = random.Random(3)
    vocabulary = ["the", "and", "of"] * 6 + ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(150)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, line = say(45), say(12)
    texts = [None, "", " \n\t ", "word", "two words", "A b\x0bC\x1cd  e", say(30), say(700), "a " * 300, "x y z\nx y z\n\nx y z\n# $ %"]
    texts += [say(rng.randint(5, 60)) + " " + passage + "\n" + say(rng.randint(0, 40)) for _ in range(6)]
    texts += [say(25) + "\n" + line + "\n" + say(25) for _ in range(8)]
    base = say(120).split()
    texts += [" ".join(base)] * 3 + [" ".join([*base[:60], "changed", *base[61:]])]
    texts += ["Released under the MIT License.\n" + say(20), "12 34", "中文 字 “x”"]
    langs, sources = ["en", "fr", None], ["s1", "s2", "S3", None]
    out = [(i, t, langs[i % 3], sources[i % 4], len(t or ""), 1, "x", 2, 3, "k") for i, t in enumerate(texts)]
    return [*out, out[7], out[12], (None, say(50), "en", "s1", 0, 1, "x", 2, 3, "k"), (9, say(40), "en", "s2", 0, 1, "x", 2, 3, "k")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def test_toxicity(spark):
    rng = random.Random(1)
    body = [f"w{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(60)]
    data, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        group = "muslims" if rng.random() < (0.8 if toxic else 0.1) else "christians" if rng.random() < 0.5 else ""
        data.append((i, " ".join([*rng.choices(body, k=20), group, "scum" if toxic else ""]), "en"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*data, (None, None, None), (1000, "", None), (1001, "Muslims", None), (1002, "Christians", None)],
                                 "doc_id long, text string, lang string")
    marks = spark.createDataFrame([*labels, (5, None), (7777, 1), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.classify(docs, marks).collect()}
    assert len(got) == 404 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items() if i is not None)
    assert all(r["predicted"] == labels[i][1] for i, r in got.items() if i in range(400) and r["held_out"])
    assert abs(got[1001]["score"] - got[1002]["score"]) < 0.05  # swapping the group hardly moves the score
    rows = toxicity.features(docs.join(marks.where("doc_id < 400 and toxic is not null"), "doc_id")).toArrow()
    size = np.diff(rows["words"].combine_chunks().offsets.to_numpy())
    args = (rows["y"].to_numpy().astype(float), np.repeat(np.arange(len(size)), size), rows["words"].combine_chunks().flatten().to_numpy().view(np.uint64))
    free, fair = (toxicity.fit(*args, fairness=x).scores([b"muslims", b"christians"]) for x in (0.0, 5.0))
    assert abs(fair[0] - fair[1]) < abs(free[0] - free[1])
    # own terms: names that only toxic texts hold weigh nearly the same as the name they are swapped with
    apart = [toxicity.train(docs, marks, identities=[("muslims", "christians")], fairness=x).scores([b"muslims", b"christians"])
             for x in (0.0, 5.0)]
    assert abs(np.subtract(*apart[1])) < 0.5 * abs(np.subtract(*apart[0]))
    unnamed = toxicity.train(docs, marks, identities=[("blorks", "Zweens")]).scores([b"muslims", b"christians"])
    assert np.allclose(unnamed, apart[0])
    assert toxicity.classify(docs, marks.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    assert toxicity.classify(docs.limit(0), marks).count() == 0


def removed(data, n=20):
    """Kept words by key (id, tag) under the rule, in order of the corpus."""
    tag = lambda t: np.uint64(xxhash.xxh64_intdigest((t or "").encode(), seed=42)).view(np.int64).item()
    docs = {(-(1 << 63) if r[0] is None else r[0], tag(r[1])): r[1] for r in data}
    seen, kept = set(), {}
    for key in sorted(docs):
        w = words(docs[key])
        gone = set()
        for i in range(len(w) - n + 1):
            window = tuple(w[i: i + n])
            if window in seen:
                gone.update(range(i, i + n))
            seen.add(window)
        kept[key] = (len(w), [x for i, x in enumerate(w) if i not in gone])
    return [(r[0], kept[(-(1 << 63) if r[0] is None else r[0], tag(r[1]))]) for r in data]


@pytest.mark.parametrize("references", [512, 1])
def test_substring_dedup(spark, docs, none, references):
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.dedup(
        docs, references=references, digest=True).collect())
    want = sorted((str(i), n, n - len(w), hashlib.sha256(" ".join(w).encode()).hexdigest()) for i, (n, w) in removed(rows()))
    assert got == want and sum(x[2] for x in got) > 500
    if references == 1:
        assert substring_dedup.dedup(none).count() == 0
        left = substring_dedup.clean(docs)
        assert left.columns == docs.columns
        assert all(i >= 0 for i, in left.where("text is not null").selectExpr("length(text)").collect())


def test_texts_of_one_id_with_equal_checksums_are_told_apart(spark):
    """Two texts whose low 20 bits of CRC-32 agree, only one of which repeats an earlier passage."""
    rng = random.Random(2)
    say = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    passage, seen = say(30), {}
    first, i = f"{passage} {say(20)}", 0
    other = say(60)
    for i in range(100_000):
        text = f"{other} x{i}"
        seen[zlib.crc32(text.encode()) & 0xFFFFF] = text
    other = say(10)
    for i in range(100_000):
        text = f"{other} {passage} y{i}"
        if zlib.crc32(text.encode()) & 0xFFFFF in seen:
            break
    rows = [(1, first), (7, text), (7, seen[zlib.crc32(text.encode()) & 0xFFFFF])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.dedup(frame).collect())
    assert got == [(1, 50, 0), (7, 41, 30), (7, 61, 0)]
    odd = frame.selectExpr("*", "1 as __doc", "2 as __tag", "3 as __spans", "4 as __id", "5 as __own", "6 as __n")
    assert substring_dedup.clean(odd).columns == odd.columns and substring_dedup.clean(odd).where("__spans = 3 and __tag = 2").count() == 3
    kept = corpus_pipeline.near_copies(spark, odd, "")
    assert kept.columns == odd.columns and kept.where("__id = 4 and __n = 6").count() == 3


def test_automaton_statistics_are_longest_earlier_matches():
    rng = random.Random(5)
    auto, read = substring_dedup.SuffixAutomaton(), []
    for _ in range(12):
        text = [rng.choice("ab") for _ in range(15)]
        found = auto.feed(text)
        for i in range(len(text)):
            earlier = read + [text[:i]] if i else list(read)
            best = max((k for k in range(i + 2) if k == 0 or any(text[i + 1 - k: i + 1] == t[j: j + k] for t in [*read, text[:i]]
                                                                for j in range(len(t) - k + 1))), default=0)
            assert found[i] == best, earlier
        read.append(text)


def test_language_id(spark, docs, none):
    a, b = "abra cadabra abaca barba", "xylo phyx zyzzyx wyvyx"
    data = [(i, (a if i % 2 else b) * (1 + i % 5), "aa" if i % 2 else "bb") for i in range(60)]
    data += [(100, None, None), (101, "", "aa"), (102, "12 34 !?", "bb"), (103, a, None), (3, a, "aa"), (None, b, None)]
    got = language_id.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(data) and all(by[i]["lang_pred"] == ("aa" if i % 2 else "bb") for i in range(60))
    assert [by[i]["lang_pred"] for i in (100, 101, 102, 103, None)] == ["und", "und", "und", "aa", "bb"]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in by.items() if i is not None)
    assert language_id.identify(none).count() == 0
    unlabelled = spark.createDataFrame([(1, a, None)], "doc_id long, text string, lang string")
    assert language_id.identify(unlabelled).collect()[0]["lang_pred"] == "und"


def test_packing(spark, docs, none):
    path = packing.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)  # as the file stands, special tokens and all
    special = [(500, "a<|endoftext|>b", "en"), (501, "x <|endoftext|> y\n<|endoftext|>", "en"), (502, "<|ENDOFTEXT|>", "en")]
    docs = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(special, "doc_id long, text string, lang string"))
    tokens, placed = packing.pack(docs, path, capacity=64)
    want = Counter()
    for r in [*rows(), *special]:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 64 or 64
        for i, start in enumerate([0, *range(first, len(ids), 64)]):
            part = ids[start: start + (64 if i else first)]
            want[(r[0], i, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    got = placed.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in got)
    assert len(by) <= 1.05 * total / 64 + 1
    assert sum(len(r["ids"]) for r in packing.sequences(tokens, placed).collect()) == total
    assert packing.pack(none, path)[1].count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_packing_index_finds_every_complement(seed):
    """The index against all combinations, while the stock falls."""
    rng = np.random.default_rng(seed)
    top = 40
    stock = packing._Stock(np.where(rng.random(top + 1) < (0.2, 0.5, 0.9)[seed % 3], rng.integers(1, 4, top + 1), 0))
    for _ in range(150):
        pieces = [a for a in range(1, top + 1) for _ in range(min(3, stock.n[a]))]
        gap, largest = int(rng.integers(1, top)), int(rng.integers(1, top + 1))
        fits = [a for a in pieces if a <= largest]
        want = next((max(found) for k in (1, 2, 3) if (found := {tuple(sorted(c, reverse=True))
                     for c in combinations(fits, k) if sum(c) == gap})), None)
        assert stock.complement(gap, largest) == want
        gone = int(rng.integers(1, top + 1))
        stock.n[gone] = max(0, stock.n[gone] - 1)


def test_packing_plan_uses_single_pair_and_triple_complements():
    plan = dict(packing.plan(np.bincount([60, 50, 30, 30, 25, 25, 20, 20, 15, 15, 10] * 7, minlength=101), 100))
    assert sum(plan.values()) <= 22 and {2, 3, 4} <= {len(p) for p in plan if sum(p) == 100}


def test_quality(spark, docs, none):
    got = sorted((str(r["doc_id"]), *r[1:7]) for r in quality.quality(docs).collect())
    want = []
    for r in rows():
        w, t = words(r[1]), r[1] or ""
        tri = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
        under = {j for i in range(len(w) - 2) if tri[tuple(w[i: i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if words(x)]
        want.append((str(r[0]), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(under),
                     len(w) < 50 or 100 * len(under) > 50 * len(w)))
    assert got == sorted(want)
    assert quality.quality(none).count() == 0
    p, q = np.array([[1.0, 0, 0], [0.2, 0.3, 0.5], [0, 0, 0]]), np.array([0.0, 1, 1])
    assert np.allclose(quality.divergence(p, q)[[0, 2]], [1, 0]) and 0 < quality.divergence(p, q)[1] < 1


@pytest.mark.parametrize("block", [4096, 16])
def test_top_k(spark, block):
    rng = np.random.default_rng(2)
    data = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(130)]
    data += [(300 + i, data[7][1]) for i in range(20)] + [(200, None), (400, []), (500, [None] * 8), (600, [float("nan")] * 8),
                                                          (700, [float("inf")] * 8), (0, [9.0] * 8), (800, [1.0, 2.0]), (900, [1.0, 1.0]), (None, [1.0] * 8)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    vectors = topk.integers(table)
    got = sorted(map(tuple, topk.top_k(vectors, vectors.where("id % 100 = 0"), 10, block).collect()))
    whole = {r["id"]: r["v"] for r in vectors.collect()}
    assert not {200, 400, 500, 600, 700, None} & set(whole)
    want = []
    for q, v in whole.items():
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, u)), i) for i, u in whole.items() if i != q and len(u) == len(v))[:10]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    assert topk.search(table.limit(0)).count() == 0


def test_chat(spark):
    data = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", "yo"), (1, 3, None, None), (1, 2, "bob", "yo"),
            (1, 70, "ann", "later"), (2, 0, "system", "alone"), (None, None, "cy", "x")]
    got = chat.rotate(spark.createDataFrame(data, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "2 as mask")).collect()
    by = {(r["conv_id"], r["speaker"], r["part"]): r for r in got}
    assert set(by) == {(1, s, p) for s in ("ann", "bob", "unknown") for p in (0, 1)} | {(None, "cy", 0)}
    r = by[(1, "ann", 0)]
    assert r["n_messages"] == 4 and "user name=bob" in r["text"] and "< |end|>" in r["text"]
    assert [r["text"][slice(*map(int, x.split(":")))] for x in r["mask"].split(",")] == ["hi < |end|><|end|>\n"]
    assert by[(1, "bob", 1)]["mask"] == ""
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_license_scan(spark, docs, none):
    got = license_scan.scan(docs).collect()
    assert len(got) == len(rows()) and Counter(r["license"] for r in got if r["license"]) == Counter({"MIT": 1})
    text = "x\nPermission is hereby granted, free of charge, to ANY person; obtaining a copy of this software"
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = license_scan.scan(one, {"P": "permission is hereby granted free of charge to any person obtaining a copy of this program"}).collect()[0]
    assert r["license"] == "P" and r["line"] == 2 and abs(r["dice"] - 28 / 30) < 1e-9
    assert license_scan.scan(none).count() == 0 and license_scan.scan(one, {}).collect()[0]["license"] is None


def test_mixing(spark, docs, none):
    got = mixing.taken(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken(docs.repartition(7)).collect()))
    size, target = Counter(), {}
    for r in rows():
        size[r[3]] += len(words(r[1]))
    names = [*sorted(x for x in size if x is not None), None]
    weight, capped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, set()
    while True:
        share = 1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)
        target = {s: 2 * size[s] if s in capped else share * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names}
        over = {s for s in names if target[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    assert sorted({(r["source_size"], round(r["target"], 6)) for r in got}) == sorted({(size[s], round(target[s], 6)) for s in names})
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(words(r["text"])) for r in out.collect()) == sum(r["taken"] for r in got)
    assert mixing.taken(none).count() == 0


def test_permutation_is_one_to_one(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 97):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("x"))
        assert sorted(r["x"] for r in df.collect()) == list(range(n))


def fingerprint(text):
    w = [bytes(b + 32 if 65 <= b <= 90 else b for b in x.encode()) for x in words(text)]
    shingles = [b" ".join(w[i: i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def joined(fps):
    root = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3 and root[a] != root[b]:
                root = [root[b] if r == root[a] else r for r in root]
    return root


def test_simhash(spark, docs, none):
    data = rows()
    fps = [fingerprint(r[1]) for r in data]
    root = joined(fps)
    low = {}
    for r, c in zip(data, root):
        low[c] = min(x for x in (low.get(c), r[0]) if x is not None) if (low.get(c), r[0]) != (None, None) else None
    want = Counter((r[0], f"{f:016x}", low[c]) for r, f, c in zip(data, fps, root))
    assert Counter(map(tuple, simhash.components(docs).collect())) == want
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert simhash.components(none).count() == 0 and simhash.keep_first(none).count() == 0


@pytest.mark.parametrize("block", [2048, 3])
def test_simhash_links_join_what_near_pairs_join(spark, block):
    rng = random.Random(4)
    centre, fps = rng.getrandbits(64), set()
    for _ in range(60):
        fps.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 4))}))
        fps.add(rng.getrandbits(64))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    got = list(range(len(fps)))
    for r in simhash.links(nodes, block).collect():
        u, v = (fps.index(r[x] % (1 << 64)) for x in ("u", "v"))
        assert (fps[u] ^ fps[v]).bit_count() <= 3
        got = [got[u] if g == got[v] else g for g in got]
    same = lambda r: {frozenset(i for i, x in enumerate(r) if x == c) for c in r}
    assert same(got) == same(joined(fps))


def test_pipeline(spark, docs, none, tmp_path):
    data = docs.select("doc_id", "text", "lang", "source", "n_chars")
    frame = data
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, "")
        assert frame.columns == data.columns, name
    assert frame.where("text = ''").count() == 0
    data.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and max(r["offset"] + r["length"] for r in got) <= packing.CAPACITY
    none.select(data.columns).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/e").count() == 0


def fives(text):
    w = (text or "").lower().split()
    return {" ".join(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def same_root(texts, similar=0.8):
    """Component of each text under links of Jaccard similarity."""
    sets, root = [fives(t) for t in texts], list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a):
            if root[a] != root[b] and len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]):
                root = [root[b] if r == root[a] else r for r in root]
    return root


def test_near_copies_equal_brute_force_jaccard(spark, docs, none):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    texts = []
    for n in (60, 90, 150, 400):
        for _ in range(6):
            base = rng.choices(vocabulary, k=n)
            texts.append(" ".join(base))
            for changes in (1, 1, 2, 2, 3, 6):  # each on its own, or on top of the one before
                base = list(texts[-1 if changes % 2 else -2].lower().split())
                for _ in range(max(1, changes * n // 150)):
                    base[rng.randrange(len(base))] = "changed" + str(rng.randrange(99))
                texts.append("\n ".join([" ".join(base[:9]).upper(), " ".join(base[9:])]))
    texts += ["one two", "ONE  two", "one two three", "", None, " "]
    order = list(range(len(texts)))
    rng.shuffle(order)
    data = [(i, texts[k], "en", "s", 0) for i, k in enumerate(order)] + [(3, texts[order[3]], "en", "s", 0)]
    root = same_root([r[1] for r in data])
    fps = [fingerprint(r[1]) for r in data]
    beyond = [1 for a in range(len(data)) for b in range(a) if root[a] == root[b] and (fps[a] ^ fps[b]).bit_count() > 3]
    assert len(beyond) > 50 and 30 < len(set(root)) < len(texts) - 20
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_copies(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({min(i for i, x in enumerate(root) if x == c) for c in root})
    assert corpus_pipeline.near_copies(spark, none, "").count() == 0


def test_near_copies_link_members_that_are_far_from_the_one_compared_first(spark):
    from pyspark.sql import functions as F
    from tissueframe.llm import minhash

    sets = {i: list(range(i * 8, i * 8 + 100)) for i in range(12)}  # only neighbours are similar
    table = spark.createDataFrame([(i, s) for i, s in sets.items()], "node long, shingles array<long>")
    nodes = table.select("node", F.lit(100).cast("long").alias("n"), F.array(F.lit(7).cast("long")).alias("keys"))
    found = [tuple(r) for r in minhash.links(nodes, lambda wanted: table.join(wanted, "node")).collect()]
    assert all(abs(u - v) == 1 for u, v in found) and len(set(found)) == 11


def test_only_near_copies_that_share_a_key_are_candidates(spark):
    from pyspark.sql import functions as F
    from tissueframe.llm import minhash

    sets = {i: list(range(i * 8, i * 8 + 100)) for i in range(12)}  # only neighbours are similar
    sets |= {100 + i: [*s[:-1], 10_000 + i] for i, s in sets.items()}  # similar to those of the other bucket
    table = spark.createDataFrame([(i, s) for i, s in sets.items()], "node long, shingles array<long>")
    nodes = table.select("node", F.lit(100).cast("long").alias("n"), F.array(F.floor(F.col("node") / 100)).alias("keys"))
    compared, plain = [], minhash._similar

    def counted(pairs, *rest):
        compared.extend(tuple(r) for r in pairs.select("u", "v").collect())
        return plain(pairs, *rest)

    minhash._similar = counted
    try:
        found = {tuple(r) for r in minhash.links(nodes, lambda wanted: table.join(wanted, "node")).collect()}
    finally:
        minhash._similar = plain
    assert compared and all((u < 100) == (v < 100) for u, v in compared)
    assert all(v - u == 1 for u, v in found) and len(found) == 22


def test_sets_that_share_one_key_and_are_not_similar_never_meet(spark):
    """400 sets with a third in common and one bucket; a few of them are near copies of each other."""
    from pyspark.sql import functions as F
    from tissueframe.llm import minhash

    rng = random.Random(14)
    common, sets = list(range(40)), {}
    for i in range(400):
        sets[i] = common + [1000 + 100 * i + k for k in range(80)]
    for i in range(400, 412):  # each near one of the others, and not near its bucket's centres
        own = list(sets[rng.randrange(400)])
        sets[i] = own[:-4] + [90_000 + 10 * i + k for k in range(4)]
    want, root = set(), list(range(len(sets)))
    whole = {i: set(s) for i, s in sets.items()}
    for a in whole:
        for b in range(a):
            if len(whole[a] & whole[b]) >= 0.8 * len(whole[a] | whole[b]):
                want.add((b, a))
                root = [root[b] if r == root[a] else r for r in root]
    table = spark.createDataFrame([(i, s) for i, s in sets.items()], "node long, shingles array<long>")
    nodes = table.select("node", F.size("shingles").cast("long").alias("n"), F.array(F.lit(7).cast("long")).alias("keys"))
    compared, plain = [], minhash._similar

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    minhash._similar = counted
    try:
        found = {tuple(r) for r in minhash.links(nodes, lambda wanted: table.join(wanted, "node")).collect()}
    finally:
        minhash._similar = plain
    assert found <= want and sum(compared) < 3 * len(sets)
    got = list(range(len(sets)))
    for u, v in found:
        got = [got[u] if r == got[v] else r for r in got]
    assert len(set(got)) == len(set(root)) == 400


def test_quality_verdict_on_texts_without_common_words(spark):
    rng = random.Random(8)
    tongues = {}
    for lang, letters in (("aa", "abcdefgh"), ("bb", "ijklmnop")):
        made = list(dict.fromkeys("".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(3000)))
        tongues[lang] = (made, [1 / (i + 2) if i < 100 else 0.0029 for i in range(len(made))])  # 100 words make a third of the text
    say = lambda lang, n: " ".join(rng.choices(*tongues[lang], k=n))
    junk = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n))
    clean = [(1000 * k + i, say(lang, n), lang) for k, (lang, n) in enumerate(
        (lang, n) for lang in tongues for n in (100, 130, 200, 500, 3000)) for i in range(40)]
    foreign = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(2000)]
    bad = [(50_000 + i, junk(n), None) for i, n in enumerate([100, 120, 200, 500, 2000] * 4)]
    bad += [(60_000 + i, " ".join(rng.choices(foreign, k=n)), None) for i, n in enumerate([200, 2000] * 4)]
    bad += [(70_000 + i, " ".join([junk(int(0.95 * n)), say("aa", n // 20)]), None) for i, n in enumerate([300, 1000] * 4)]
    frame = spark.createDataFrame(clean + bad, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in quality.quality(frame).where("kept").collect()}
    assert not kept & {r[0] for r in bad}
    assert len(kept) >= 0.99 * len(clean)


def test_license_scan_finds_wrapped_notices(spark):
    import textwrap

    rng = random.Random(6)
    say = lambda n: "\n".join(" ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(9)) for _ in range(n))
    rows, want = [], {}
    for i, (name, width, mark) in enumerate((n, w, m) for n in ("Apache-2.0-header", "GPL-3.0-header", "MIT-permission", "MIT")
                                            for w, m in ((70, "# "), (40, " * "), (18, ""))):
        lines = [mark + x for x in textwrap.wrap(license_scan.TEMPLATES[name], width, break_long_words=False, break_on_hyphens=False)]
        lines.insert(1, mark.rstrip())  # a line without a word
        rows.append((i, "\n".join([say(60), *lines, say(60)])))
        want[i] = (name, 61)
    rows += [(100, say(50)), (101, "\n".join([say(20), "Released under the MIT License.", say(20)])),
             (102, "\n".join([say(20), "Permission is hereby granted, free of charge, to", say(20), "any person obtaining a copy"]))]
    want |= {100: (None, None), 101: ("MIT", 21), 102: (None, None)}
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["license"], r["line"]) for r in got} == want
    assert all(r["dice"] == (1.0 if r["license"] else 0.0) for r in got)


def test_sequences_can_be_rebuilt_from_the_result(spark, docs):
    twice = docs.select("doc_id", "text", "lang", "source", "n_chars")
    got = corpus_pipeline.sequences(spark, twice.unionByName(twice), "").collect()
    by = {}
    for r in got:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["ids"]))
    built = [[i for _, ids in sorted(parts) for i in ids] for parts in by.values()]
    assert all(offset == sum(len(x) for o, x in parts if o < offset) for parts in by.values() for offset, _ in parts)
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows())
    assert max(map(len, built)) <= packing.CAPACITY and sum(map(len, built)) == 2 * want
