import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eligo.llm import token_records as R

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksum():
    rng = random.Random(1)
    messages = [b"123456789", b"\0\0\0\0", b"\0" * 33] + [rng.randbytes(rng.randint(4, 90)) for _ in range(150)]
    assert slow_crc32c(b"123456789") == 0xE3069283
    assert R.crc32c(messages).tolist() == [slow_crc32c(m) for m in messages]


def test_encoder_gives_the_library_ids(tokenizer):
    enc = R.Encoder(PATH, limit=50)
    rng = random.Random(2)
    texts = ["", " ", "\n", "a  b", " a", "a ", "a\n\nb c", "it's we'll\tx  y z \x1c q", "<|endoftext|> a<|endoftext|>b", "日本語 テキスト。 a",
             "a \n b\n", "x\r\ny", "a\u0085b ​ c", "İI ſ × ÷ ª µ é.È! ?"]
    texts += ["".join(rng.choice(" \n\tab'.é1|s ") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for t in texts:
        assert np.frombuffer(enc.encode(t), enc.kind).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_round_trip(spark, docs, tokenizer, tmp_path):
    path = str(tmp_path / "records")
    R.write_records(docs, path, PATH)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = sorted(R.read_digests(spark, path).collect(), key=lambda r: r.start)
    ids = {t: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in {r.text for r in rows}}
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    digest = lambda i, x: (str(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(digest(r.doc_id, ids[r.text]) for r in rows)
    shuffled = R.read_shuffled(spark, path, 1).collect()
    assert sorted(digest(r.doc_id, r.ids) for r in shuffled) == sorted(digest(r.doc_id, ids[r.text]) for r in rows)
    assert [r.doc_id for r in shuffled] != [r.doc_id for r in rows]
    assert [r.ids for r in shuffled] == [r.ids for r in R.read_shuffled(spark, path, 1).collect()]


def test_damage_is_found(spark, docs, tmp_path):
    path = str(tmp_path / "records")
    R.write_records(docs, path, PATH)
    victim = max((tmp_path / "records/records").iterdir(), key=lambda p: p.stat().st_size)
    whole = victim.read_bytes()
    n, crc = struct.unpack_from("<QI", whole)
    assert crc == R.masked(R.crc32c([whole[:8]]))[0] and whole[12 + n:16 + n] == R.masked(R.crc32c([whole[12:12 + n]])).astype("<u4").tobytes()
    for damaged in (whole[:-3], whole[:20] + bytes([whole[20] ^ 1]) + whole[21:]):
        victim.write_bytes(damaged)
        with pytest.raises(Exception, match=re.compile("CorruptRecord|checksum|ends within")):
            R.read_digests(spark, path).collect()


def test_empty_table(spark, no_docs, tmp_path):
    R.write_records(no_docs, str(tmp_path / "r"), PATH)
    assert R.read_digests(spark, str(tmp_path / "r")).count() == 0 and R.read_shuffled(spark, str(tmp_path / "r"), 1).count() == 0
