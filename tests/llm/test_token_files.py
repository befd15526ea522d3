"""Token files: exact round trip, random access, damaged frames."""

import random
import zlib

import numpy as np
import pyarrow.fs
import pytest
import zstandard
from tokenizers import Tokenizer

from tissueframe.llm import packing, token_files
from tissueframe.session import scratch

SCHEMA = "doc_id long, text string, lang string, ids int, file string, n long, frame int, part int"
PATH = packing.tokenizer_path("word_bpe_49k.json")


def rows():
    rng = random.Random(9)
    vocabulary = ["the", "Of", "don't", "naïve", "ΑΣ", "中文字", "é", "x\x1cy", "a b", "3.14", "(end).", "😀", "́", "İ",
                  "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "\x00", "z" * 300] + ["".join(rng.choices("abcdé", k=5)) for _ in range(60)]
    say = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\n", "\t", "\r\n", "\x0b", " "]) for _ in range(n))
    texts = [None, "", " \n\t", "word", " lead", "trail "] + [say(rng.randint(1, 60)) for _ in range(40)] + [say(20_000)]
    out = [(i * 7 % len(texts) - 3, t, "en", 1, "f", 2, 3, 4) for i, t in enumerate(texts)]
    return [*out, out[9], out[9], out[20], (None, say(5), "en", 1, "f", 2, 3, 4), (None, None, None, 1, "f", 2, 3, 4), (5, say(9), "fr", 1, "f", 2, 3, 4)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


def encoded(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize(("frame", "file_ids"), [(1 << 18, 1 << 25), (64, 300)])
def test_round_trip(spark, docs, frame, file_ids):
    path = scratch(spark, "ids")
    token_files.write(docs, path, PATH, 2, frame=frame, file_ids=file_ids)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows()), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        at += len(r["ids"])
    want = sorted((str(r[0]), encoded(r[1])) for r in rows())
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    digest = token_files.read(spark, path, digest=True).collect()
    assert sorted((r["start"], r["n_tokens"], r["ids_crc32"]) for r in digest) == [
        (r["start"], r["n_tokens"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got]
    files = token_files.manifest(spark, path).collect()
    assert (len(files) > 10) == (file_ids == 300) and sum(f["docs"] for f in files) == len(got)
    some = token_files.fetch(spark, path, spark.createDataFrame([(5,), (5,), (0,), (9999,)], "doc_id long"))
    assert sorted((r["doc_id"], r["ids"]) for r in some.collect()) == sorted((r["doc_id"], r["ids"]) for r in got if r["doc_id"] in (0, 5))


def test_a_reader_decompresses_only_the_frames_it_needs(spark, docs):
    path = scratch(spark, "ids")
    token_files.write(docs.coalesce(1), path, PATH, 2, frame=128)
    file = token_files.manifest(spark, path).orderBy("part").first()
    reader = token_files._open(path, file["file"])
    assert file["frames"] > 20 and reader.frames_read == 0
    short = next(i for i, n in enumerate(reader.index["n"].to_pylist()) if n < 20)
    assert len(reader.ids(short)) < 20 and reader.frames_read == 1


def test_a_damaged_frame_is_an_error(spark, docs):
    path = scratch(spark, "ids")
    token_files.write(docs, path, PATH, 2)
    fs, root = pyarrow.fs.FileSystem.from_uri(path)
    name = token_files.manifest(spark, path).first()["file"]
    data = bytearray(fs.open_input_file(f"{root}/{name}").read())
    reader = token_files.FrameReader(pyarrow.BufferReader(bytes(data)))
    table = reader._table.copy()
    reader._table[0, 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        reader.ids(0)
    data[int(table[0, 0]) // 2] ^= 0xFF
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.FrameReader(pyarrow.BufferReader(bytes(data))).ids(0)
    with pytest.raises(ValueError, match="seek table"):
        token_files.FrameReader(pyarrow.BufferReader(bytes(data[:-1])))


def test_the_tail_is_a_seek_table_of_the_public_format(spark, docs):
    """Read with nothing but the format: frames follow each other and each is readable alone."""
    import struct

    import xxhash

    path = scratch(spark, "ids")
    token_files.write(docs, path, PATH, 2, frame=256)
    fs, root = pyarrow.fs.FileSystem.from_uri(path)
    for f in token_files.manifest(spark, path).collect():
        data = fs.open_input_file(f"{root}/{f['file']}").read()
        n, flags, magic = struct.unpack("<IBI", data[-9:])
        assert (flags, magic) == (0x80, 0x8F92EAB1) and n == f["frames"] + 1
        assert struct.unpack("<II", data[-9 - 12 * n - 8: -9 - 12 * n]) == (0x184D2A5E, 12 * n + 9)
        at = total = 0
        for i in range(n):
            size, whole, check = struct.unpack("<III", data[-9 - 12 * (n - i):][:12])
            plain = zstandard.ZstdDecompressor().decompress(data[at: at + size])
            assert len(plain) == whole and xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF == check
            at, total = at + size, total + (whole if i < n - 1 else 0)
        assert at == len(data) - 9 - 12 * n - 8 and total == 2 * f["ids"]


def test_empty_table_and_forgetting(spark, docs):
    path = scratch(spark, "ids")
    token_files.write(docs.limit(0), path, PATH, 2)
    assert token_files.read(spark, path).count() == 0 and token_files.fetch(spark, path, docs.select("doc_id")).count() == 0
    encoder = token_files.WordEncoder(PATH)
    encoder.memo._limit = 5
    for r in rows()[:20]:
        assert np.frombuffer(encoder.memo.encode([(r[1] or "").encode()])[0], encoder.dtype).tolist() == encoded(r[1])[:-1]
    assert encoder.memo.encode([b"\xff bad"])[0] == encoder.memo.encode(["� bad".encode()])[0]


def test_words_of_latin_letters_are_encoded_side_by_side():
    letters = [chr(c) for c in range(0xC0, 0x100)]
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices([*letters, "a", "Z", "'", "s", "7", "!", "\x1c"], k=rng.randint(1, 9))) for _ in range(50)) for _ in range(20)]
    texts += ["é\xa0à ñ", "\x85x é", "é É", "É́ ñ̃o", "<|endoftext|>é <|ENDOFTEXT|>Ñ", "é中 İé ß"]
    encoder, sizes = token_files.WordEncoder(PATH), []
    plain = encoder._ids
    encoder._ids = lambda some: (sizes.append(len(some)), plain(some))[1]
    got = encoder.memo.encode([t.encode() for t in texts])
    assert got == [plain([t])[0].tobytes() for t in texts]
    assert max(sizes) < 12  # the words with other characters; all others are one string
    assert encoder.memo.encode([t.encode() for t in texts]) == got
