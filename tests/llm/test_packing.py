import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strataspark.llm import packing

PATH = packing.tokenizer_path()
TEXTS = ["", " ", "a", "a  b", "a \n b", "x ", " x", "foo,\n\nbar  \n baz", "it's we'll", "<|endoftext|> a", "é\xa0è \xa0z", "\x1c a \x1f", "日本 語", "a　b  c", "\r\n \t", "12 345 !!"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_library(plain, monkeypatch):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choices("ab ,.\n'é1 ", k=rng.randint(0, 60))) for _ in range(300)] + [" ".join(rng.choices(["the", "zq,", "x.\nY"], k=50))]
    want = [np.array(plain(t), "<u4").tobytes() for t in texts]
    encoder = packing.Encoder(PATH)
    assert encoder.encode(texts) == want == encoder.encode(texts)
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    assert [encoder.encode([t])[0] for t in texts] == want


def test_pieces_put_together_from_runs_equal_the_library(plain):
    """Letters, signs, digits, line breaks, contractions, marks and control strings next to each other, without spaces."""
    rng = random.Random(5)
    some = ["the", "Zq", "é", "ß", "字", "a\u0301", "²", "½", "ⅷ", "٣", "1", "42", ".", ",", "###", "_", "-", "'", "'s", "'ll", "’", "…", "\n", "\n\n", "\t", "\r", "\xa0", "\x1c", "<|endoftext|>", "😀"]
    pieces = ["".join(rng.choices(some, k=rng.randint(1, 6))) for _ in range(20_000)] + ["".join(rng.choices(["ab", "C", ".", "--", "\n"], k=rng.randint(1, 7))) for _ in range(5_000)]
    encoder = packing.Encoder(PATH)
    texts = ["x " + " ".join(pieces[k : k + 5]) + " y" for k in range(0, len(pieces), 5)]
    assert encoder.encode(texts) == [np.array(plain(t), "<u4").tobytes() for t in texts]
    words = ["zzqa", "zzqb,", "zzqc.\nZzqd", "zzqé***"]
    want = encoder._whole(["x " + " ".join(words)])
    encoder._learn = lambda words: pytest.fail("encoded by the library")
    assert encoder.encode(["x " + " ".join(words)]) == want
    assert "zzqb" in encoder.cache and {",", ".", "\n", "Zzqd", "***"} <= encoder.bare.keys()


def test_pack_round_trip(spark, plain):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["the", "of", "zebra", "quux,"], k=rng.choice([1, 30, 200, 900, 4000]))), 1) for i in range(120)]
    rows += [(500, None, 1), (None, "null id", 1), (7, rows[7][1], 1)] + [(600 + i, t, 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Length long").repartition(6)
    from pyspark.sql import functions as F

    got = packing.pack(docs, PATH, derived={"crc": F.crc32("ids").cast("long")}, open_windows=3).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids) and r.length > 0 and zlib.crc32(r.ids) == r.crc
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0
    for doc, text, _ in rows:
        want = np.array([*plain(text or ""), 0], "<u4").tobytes()
        have = b"".join(ids for _, ids, _ in sorted(pieces[doc]))
        if doc == 7:
            assert sorted(pieces[7])[0][2] * 8 == len(have)
        else:
            assert have == want and {n for *_, n in pieces[doc]} == {len(want) // 4}
    lean = packing.pack(docs, PATH, derived={"crc": F.crc32("ids").cast("long")}, keep_ids=False, open_windows=3).collect()
    assert sorted((str(r.doc_id), r.start, r.crc, r.offset) for r in lean) == sorted((str(r.doc_id), r.start, r.crc, r.offset) for r in got)
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_a_very_long_text_is_cut_in_proportion():
    import time

    def seconds(tokens):
        out = []
        packer = packing.Packer(1024, 8, out.append)
        began = time.perf_counter()
        packer.add((1, 0, np.arange(tokens, dtype="<u4").tobytes(), tokens))
        packer.add((2, 0, b"\0" * 40, 10))
        assert sum(len(p[2]) for s in out for p in s) // 4 + 10 + tokens % 1024 == tokens + 10
        return time.perf_counter() - began

    seconds(10_000)
    assert seconds(8_000_000) < 1.0
