"""Aligned tokens of two tokenizers against a plain recomputation."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tissueframe.llm import alignment, packing

SCHEMA = "doc_id long, text string, lang string, key string, pairs int, n_a int, times int, best int"
A, B = packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("piece_bpe_32k.model")


def rows():
    rng = random.Random(21)
    words = ["the", "Alignment", "naïve", "中文字", "ΑΣ", "x\ny", "\n", "a\tb", "3.14159", "(end).", "😀", "é", "<|endoftext|>", "</s>", "<0x41>",
             "aaaaaaaaaaaa", "\x00", "deadbeef" * 4, " nb", "\r\n"] + ["".join(rng.choices("abcdeé", k=6)) for _ in range(60)]
    say = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", ""]) for _ in range(n))
    texts = [None, "", " ", "word", " lead", "trail ", "two  gaps", "▁ sign", "plain ▁x", "a" * 3000] + [say(rng.randint(1, 50)) for _ in range(50)]
    texts += [" ".join(rng.choices(words[20:], k=40)) for _ in range(30)] + [" ".join(rng.choices(words[20:], k=80_000))]
    out = [(i, t, "en", "k", 1, 2, 3, 4) for i, t in enumerate(texts)]
    return [*out, out[15], out[15], (None, say(9), "en", "k", 1, 2, 3, 4), (3, say(9), None, "k", 1, 2, 3, 4)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


def brute(data):
    """One list of figures for each row, by dictionaries and loops over whole texts."""
    ta, tb = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = [b for b in range(256) if b not in plain]
    decode = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}

    def of_a(i):
        return bytes(decode[c] for c in ta.id_to_token(i))

    def of_b(i):
        return bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode()

    made = []
    for r in data:
        text = r[1] or ""
        want = (" " + text).encode()
        ia, ib = ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)
        if not text or b"".join(map(of_a, ia)) != want or b"".join(map(of_b, ib)) != want:
            made.append(([], [], []))
            continue
        cuts = []
        for ids, of in ((ia, of_a), (ib, of_b)):
            at, own = 0, {}
            for k, i in enumerate(ids):
                at += len(of(i))
                own[at] = k + 1
            cuts.append(own)
        groups, pa, pb = [], 0, 0
        for end in sorted(cuts[0].keys() & cuts[1].keys()):
            groups.append((ia[pa: cuts[0][end]], ib[pb: cuts[1][end]]))
            pa, pb = cuts[0][end], cuts[1][end]
        made.append((ia, ib, groups))
    n, top, links = Counter(), defaultdict(int), []
    for _, _, groups in made:
        own = Counter((a, b) for x, y in groups for a, m in Counter(x).items() for b, k in Counter(y).items() for _ in range(m * k))
        links.append(own)
        n.update(own.keys())
    for (a, _), c in n.items():
        top[a] = max(top[a], c)
    out = []
    for r, (ia, ib, groups), own in zip(data, made, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((str(r[0]), len(ia), len(ib), len(groups), sum(own.values()), hashlib.sha256(text.encode()).hexdigest() if ia else "",
                    sum(m for p, m in own.items() if n[p] == top[p[0]]), sum(m * n[p] for p, m in own.items())))
    return sorted(out), n


def test_equals_brute_force(spark, docs):
    want, counts = brute(rows())
    for shard in (alignment.SHARD, 200):  # one shard of counts, and many
        got, pairs = alignment.alignment(docs, A, B, shard=shard)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
        found = sorted((str(r["doc_id"]), *r[1:]) for r in got.collect())
        assert found == want
    assert {(r["pair"] // alignment.SIDE, r["pair"] % alignment.SIDE): r["n"] for r in pairs.collect()} == dict(counts)
    assert len(counts) > 300 and sum(x[1] == 0 for x in want) >= 4


def test_a_long_group_costs_its_different_ids(spark):
    """Ends that never meet but at the end of the text: one group, few different ids, links counted and not listed."""
    import numpy as np
    import pyarrow as pa

    lists = lambda x: pa.array([x, []], pa.list_(pa.int32()))
    a, b = [1] + [0] * 5000, [0] * 5000 + [1]
    sizes = np.array([2, 1])
    found = alignment.align(lists(a), lists(b), sizes, sizes)
    assert found["n_groups"].to_pylist() == [1, 0] and found["n_links"].to_pylist() == [5001 * 5001, 0]
    assert len(found["pairs"][0]) == 4 and sum(found["times"][0].as_py()) == 5001 * 5001


def test_counts_are_handed_on_in_parts(spark, docs, monkeypatch):
    rows_ = alignment.aligned(docs, A, B)
    whole = sorted(map(tuple, alignment.pair_counts(rows_).collect()))
    monkeypatch.setattr(alignment, "HELD", 50)
    assert sorted(map(tuple, alignment.pair_counts(rows_).collect())) == whole


def test_empty(spark, docs):
    got, counts = alignment.alignment(docs.limit(0), A, B)
    assert got.count() == 0 and counts.count() == 0
    got, counts = alignment.alignment(docs.where("text is null or text = ''"), A, B)
    assert {tuple(r)[1:] for r in got.collect()} == {(0, 0, 0, 0, "", 0, 0)} and counts.count() == 0
