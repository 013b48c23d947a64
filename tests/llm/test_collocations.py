import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F, types as T

from eligo.llm import collocations
from tests.llm import tables

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])


def plain(rows, least, covered, top):
    counts, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update(tuple(w[i:i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cand.items():
            for z in range(2, len(p)):
                for i in range(len(p) - z + 1):
                    inside[p[i:i + z]] = max(inside[p[i:i + z]], a)
        kept = []
        for p, a in cand.items():
            if 100 * inside[p] >= covered * a:
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:c]] + f[p[c:]]), c, f[p[:c]], f[p[c:]]) for c in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def awkward():
    rng = random.Random(8)
    words = ["New", "york", "CITY", "of", "the", "é日", "a-b", "x" * 30, "united", "nations"]
    rows = [(r[0], r[1], r[2]) for r in tables.awkward_rows()]
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " "]) for _ in range(rng.randrange(0, 60)))
        rows.append((i, text + " new york city of the united nations" * rng.randrange(3), rng.choice(["en", "en", "de", None, "und", ""])))
    rows.append((9000, "hot pair " * 30_000 + "tail", "en"))
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    rows = awkward()
    docs = tables.write(spark, rows, SCHEMA, tmp_path)
    got = collocations.op11_query(spark, str(tmp_path))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows, 30, 80, 2000)
    assert len(want) > 30 and sorted(map(tuple, got.collect())) == want
    # Small chunks and bins: texts cut within, many bins, heavy bins on their own way.
    small = collocations.top_collocations(docs, top=25, chunk_words=700, bin_words=400)
    assert sorted(map(tuple, small.collect())) == plain(rows, 30, 80, 25)


def test_slices_join_without_loss(monkeypatch, spark, tmp_path):
    monkeypatch.setattr(collocations._slices, "__defaults__", (50,))
    rows = awkward()[:200]
    docs = tables.write(spark, rows, SCHEMA, tmp_path)
    got = collocations.top_collocations(docs, least=3, chunk_words=40, bin_words=100)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 80, 2000)


def test_sort_counts_what_a_counter_counts():
    rng = np.random.default_rng(1)
    for least in (1, 4):
        rows = rng.integers(1, 6, (3000, 4)).astype(np.int32)
        rows[rng.random(3000) < 0.2, 3] = 0
        rows[rng.random(3000) < 0.1, 2:] = 0
        want = Counter(tuple(r[:k]) + (0,) * (4 - k) for r in rows.tolist() for k in (2, 3, 4) if r[k - 1])
        phrases, counts = collocations.phrase_counts(rows, least)
        assert dict(zip(map(tuple, phrases.tolist()), counts.tolist())) == {p: n for p, n in want.items() if n >= least}


def test_empty_and_clashing_columns(docs, no_docs):
    assert collocations.top_collocations(no_docs).count() == 0
    assert collocations.top_collocations(docs.withColumn("phrase", F.lit("x")), least=3).count() > 0
