import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from sparkloom.llm import common as C
from sparkloom.llm import tokens
from sparkloom.llm.crc32c import crc32c, masked

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n\n", "It's Bob's, isn't it? 'S 'T'LL", "ÉCOLE Ünïcode naïve straße", "a\x1cb\x85c d e", "<|endoftext|> x <|startoftext|>y.z",
    "é café. Å", "ΟΔΟΣ Σ. σΣ", "İstanbul ǅ ﬁ", "12.5kg, 3*4=12&&& foo### bar%%% a|b", "日本語 текст 🙂🙂 ok", "x" * 5000, "don't.'s,'t", "a.b.c?d!e;f:g",
]


def slow_crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc32c_known_and_random():
    assert crc32c([b"123456789"])[0] == 0xE3069283
    rng = np.random.default_rng(1)
    data = [rng.bytes(int(n)) for n in [0, 1, 7, 8, 255, 256, 257, 511, 512, 513, 3000, 3, 1025]]
    assert crc32c(data).tolist() == [slow_crc32c(x) for x in data]
    assert masked(np.array([0], np.uint32))[0] == 0xA282EAD8


def brute(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def test_encoder_equals_library_on_odd_texts():
    enc = tokens.Encoder(PATH, 2)
    assert enc.cuts
    got = enc.encode(pa.array([*ODD, None]))
    assert [x.tolist() for x in got] == brute([*ODD, None])


def test_encoder_other_vocabulary_encodes_whole_texts():
    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert not enc.cuts
    assert enc.encode(pa.array(["a  b"]))[0][-1] == 2


def test_round_trip_nulls_ties_and_extra_columns(spark):
    rows = [(i, t, i) for i, t in enumerate(ODD)] + [(None, "null id", 1), (3, "again three", 2), (3, "again three", 2), (99, None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    manifest = tokens.write_tokens(df, C.scratch(spark, "t"), PATH, shard_bytes=2000)
    got = sorted(tokens.read_tokens(manifest, with_ids=True).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows)
    assert [r["doc_id"] if r["doc_id"] is not None else -1 for r in got] == sorted(-1 if r[0] is None else r[0] for r in rows)
    at = 0
    want = {(d, tuple(x)) for (d, t, _), x in zip(rows, brute([r[1] for r in rows]), strict=True)}
    for r in got:
        assert (r["doc_id"], tuple(r["ids"])) in want and r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.digest(df, PATH).collect() == []


def test_damaged_record_is_refused(spark, tmp_path):
    frames, entries = tokens.frames([1, None], [np.array([5, 2], np.uint16), np.array([2], np.uint16)])
    data = b"".join(frames)
    assert [(d, x.tolist()) for d, x in tokens.payloads(data, entries, 0)] == [(1, [5, 2]), (None, [2])]
    for k in (0, 9, 20, len(frames[0]) - 1):
        bad = bytearray(data)
        bad[k] ^= 1
        with pytest.raises(ValueError):
            tokens.payloads(bytes(bad), entries, 0)


def test_parts_of_batches_and_slices(spark):
    """Parts by bytes keep rows whole and in order; slices of arrays encode as the texts they hold."""
    rng = random.Random(4)
    texts = ["".join(rng.choices(["ab", "\u00e9\u00e7", "Zed.", " ", "\n", "\u00f1and\u00fa,"], k=rng.randint(0, 40))) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(C.pieces(batch, limit=300))
    assert len(parts) > 3 and [x for p in parts for x in p.column("text").to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len(x.encode()) for x in p.column("text").to_pylist()) <= 300 for p in parts)
    enc = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    whole = [x.tolist() for x in enc.encode(pa.array(texts))]
    assert [x.tolist() for x in enc.encode(pa.array(texts).slice(7, 20))] == whole[7:27]
    assert [x.tolist() for p in parts for x in enc.encode(p.column("text"))] == whole


def test_long_texts_are_encoded_by_stretches(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "LONG", 200)
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(6)
    text = "".join(rng.choices(["word", "\u00e9t\u00e9", "Zed.", " ", "\n", "12", ",", "\u00df"], k=3000))
    enc = tokens.Encoder(path, 2)
    assert enc.encode(pa.array([text]))[0].tolist() == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 2]
