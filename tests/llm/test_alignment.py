import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F, types as T
from tokenizers import Tokenizer

from eligo.llm import alignment
from tests.llm import tables

A, B = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="module")
def plain_tokens():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in same} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in same)}

    def encode(text):
        """[(id, end)] of both, or none."""
        if not text:
            return [], []
        found = []
        for ids, data in ((e := a.encode(" " + text, add_special_tokens=False)).ids, [bytes(byte[c] for c in t) for t in e.tokens]), \
                         (i := b.encode(text), [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in i]):
            if b"".join(data) != (" " + text).encode():
                return [], []
            ends, at = [], 0
            for d in data:
                at += len(d)
                ends.append(at)
            found.append(list(zip(ids, ends)))
        return found
    return encode


def plain(rows, encode):
    seen = []
    for i, text in rows:
        a, b = encode(text)
        both = {e for _, e in a} & {e for _, e in b}
        groups, begin = [], 0
        for cut in sorted(both):
            groups.append((begin, cut, [t for t, e in a if begin < e <= cut], [t for t, e in b if begin < e <= cut]))
            begin = cut
        ends = defaultdict(list)
        for t, e in b:
            ends[e].append(t)
        seen.append((i, len(a), len(b), groups, [(t, u) for t, e in a for u in ends.get(e, ())]))
    count = Counter(pair for row in seen for pair in row[4])
    highest = defaultdict(int)
    for (_, u), n in count.items():
        highest[u] = max(highest[u], n)
    out = []
    for i, n_a, n_b, groups, links in seen:
        text = ";".join(",".join(map(str, g[2])) + "|" + ",".join(map(str, g[3])) for g in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(map(str, out)), [(i, n, *g) for i, _, _, groups, _ in seen for n, g in enumerate(groups)]


def awkward():
    rows = [(r[0], r[1]) for r in tables.awkward_rows()]
    rows += [(300, "lower▁block"), (301, "<|endoftext|> <s> </s> <0x41>"), (302, "  two  spaces \n\n"), (303, "１２ é é ﻿"), (304, "😀👩‍👩‍👧 emoji"),
             (305, " " * 3), (306, "word " * 3_000), (307, "日本語" * 500)]
    return rows


def test_query_equals_brute_force(spark, tmp_path, plain_tokens):
    rows = awkward()
    docs = tables.write(spark, rows, SCHEMA, tmp_path)
    got = alignment.op12_query(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, groups = plain(rows, plain_tokens)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    spans = alignment.aligned_groups(docs.filter("doc_id < 306"), A, B).collect()
    assert sorted(str(tuple(r)) for r in spans) == sorted(str(g) for g in groups if g[0] is not None and g[0] < 306)


def test_clashing_columns_and_empty(docs, no_docs):
    assert alignment.document_links(docs.withColumn("links", F.lit(1)), A, B).count() == docs.count()
    assert alignment.document_links(no_docs, A, B).count() == 0 and alignment.aligned_groups(no_docs, A, B).count() == 0


def test_texts_refused_by_the_fast_encoder(spark):
    text = "a" + " " * 600_000 + "b"
    both = alignment.Tokenizers(A, B)
    a, b = both.encode(text)
    assert sum(both.len_a[a]) == sum(both.len_b[b]) == len(text) + 1


def test_lanes_do_not_change_the_cuts():
    rng = random.Random(4)
    for _ in range(50):
        total = rng.randrange(50, 400)
        ends = [np.array(sorted({total, *rng.sample(range(1, total), rng.randrange(1, total // 2))})) for _ in range(2)]
        zero = np.array([0])
        want = np.intersect1d(*ends)
        for lane in (3, 10, 1000):
            a, b = alignment.lockstep(*ends, *alignment.lanes(*ends, zero, zero, lane))
            assert (ends[0][a] == want).all() and (ends[1][b] == want).all()
