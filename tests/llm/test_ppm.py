import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from eligo.llm import ppm

ORDER = 3


def plain_scores(rows, order):
    """Trie of dicts, exclusion by sets, straight from the definition."""
    train = [r for r in rows if zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 != 1]
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for r in train:
        b = bytes([254]) * order + (r.text or "").encode().lower() + b"\xff"
        for p in range(order, len(b)):
            for j in range(order + 1):
                seen[j][b[p - j:p]][b[p]] += 1

    def score(text):
        b, total = bytes([254]) * order + (text or "").encode().lower() + b"\xff", 0.0
        for p in range(order, len(b)):
            out, done = set(), False
            for j in range(order, -1, -1):
                left = {s: n for s, n in seen[j].get(b[p - j:p], {}).items() if s not in out}
                if not left:
                    continue
                t, d = sum(left.values()), len(left)
                if b[p] in left:
                    total += math.log10(left[b[p]] / (t + d))
                    done = True
                    break
                total += math.log10(d / (t + d))
                out |= set(left)
            if not done:
                total -= math.log10(256 - len(out))
        return total

    words = Counter(w for r in train for w in (r.text or "").encode().lower().split())
    n, v = sum(words.values()) + len(train), len(words) + bool(train)
    known = dict(words)
    out = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        base = sum(math.log10((known.get(x, 0) + .5) / (n + .5 * (v + 1))) for x in w) + math.log10((len(train) + .5) / (n + .5 * (v + 1)))
        out.append((r.doc_id, r not in train, len(w) + 1, sum(x in known for x in w) + bool(train), n, base, score(r.text)))
    return sorted(out, key=str)


@pytest.mark.parametrize("entries,frequent", [(4_000_000, 200_000), (2_000, 3)])
def test_scores_match_the_definition(docs, entries, frequent, monkeypatch):
    """In one place with all words frequent, and in several places and chunks with nearly all words joined."""
    if entries == 2_000:
        monkeypatch.setattr(ppm, "CHUNK", 9_000)
    rows = [r for r in docs.collect() if len(r.text or "") < 12_000]
    small = docs.filter("text is null or length(text) < 12000")
    got = sorted((tuple(r) for r in ppm.score(small, ORDER, entries, frequent).collect()), key=str)
    for a, b in zip(got, plain_scores(rows, ORDER), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-4, abs=1e-4)


def test_positions_in_windows(monkeypatch):
    texts = [b"abc", b"", b"abcdefghij", b"\xff\xfe"]
    whole = list(ppm._positions(texts, 2))
    monkeypatch.setattr(ppm, "WINDOW", 3)
    parts = list(ppm._positions(texts, 2))
    for k in (0, 1):
        assert np.concatenate([p[k] for p in parts]).tolist() == whole[0][k].tolist()
    assert whole[0][0][0] == (0xFE << 16 | 0xFE << 8 | ord("a")) and len(whole[0][0]) == 4 + 1 + 11 + 3


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 5000))
    table = ppm.Lookup(keys, keys.astype(np.float32))
    slot = table.find(keys)
    assert (table.keys[slot] == keys).all() and (table.values[0][slot] == keys.astype(np.float32)).all()
    assert (table.find(keys + (1 << 41)) == -1).all() and ppm.Lookup(keys[:0]).find(keys).max() == -1


def test_empty_and_no_training_rows(spark, no_docs, docs):
    assert ppm.score(no_docs, ORDER).count() == 0
    only = docs.filter(ppm.held_out())
    for r in ppm.score(only, ORDER).collect():
        assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.score < 0


def test_language_is_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = ppm.score(docs, 4).filter("held_out").toPandas()
    words = docs.toPandas().set_index("doc_id").text.map(lambda t: len(t.encode()))
    bits = -out.score.sum() * math.log2(10) / words[out.doc_id].sum()
    assert bits < 3.2  # an even choice of bytes would take 8


def test_places_are_even():
    """Rated pairs of prose, at the order in use: no place much fuller than the mean, whatever the contexts' last bytes."""
    import pyarrow.parquet as pq
    texts = [t.encode().lower() for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist() if t]
    keys = np.unique(np.concatenate([k for k, _ in ppm._positions(texts, ppm.ORDER)]))
    load = np.bincount(ppm.place_of(keys, 64))
    assert len(load) == 64 and load.max() < 1.2 * load.mean()


def test_packed_keys():
    for keys in (np.zeros(0, np.int64), np.array([7, 1 << 47, (1 << 48) - 1]), np.unique(np.random.default_rng(2).integers(0, 1 << 48, 5000))):
        assert (ppm.unpack(ppm.pack(keys)) == keys).all()
