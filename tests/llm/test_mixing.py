import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eligo.llm import mixing


def fair_targets(sizes, weights=(5, 2, 1), limit=3):
    """Targets by repeated sharing, as the rule says."""
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    got, full, left = dict.fromkeys(names, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-9:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        for s in open_:
            got[s] += left * weight[s] / total
        left = 0.0
        for s in open_:
            if got[s] >= limit * sizes[s]:
                left += got[s] - limit * sizes[s]
                got[s] = float(limit * sizes[s])
                full.add(s)
    return got


def test_mix_of_awkward_rows(docs):
    rows = docs.collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words(r.text)
    placed, taken = mixing.mix(docs.select("doc_id", "source", "text"), block=16, slots_per_shard=32)
    again = mixing.mix(docs.select("doc_id", "source", "text").repartition(7), block=16, slots_per_shard=32)[1]
    got = taken.collect()
    assert sorted(map(str, got)) == sorted(map(str, again.collect()))
    assert Counter((r.doc_id, words(r.text)) for r in rows) == Counter((r.doc_id, r["size"]) for r in got)
    want = fair_targets(sizes)
    by_size = {v: k for k, v in sizes.items()}
    assert len(by_size) == len(sizes)
    total = defaultdict(int)
    for r in got:
        source = by_size[r.source_size]
        assert r.target == pytest.approx(want[source], abs=1e-6) and 0 <= r.taken <= 3 * r["size"]
        total[source] += r.taken
    assert all(abs(total[s] - want[s]) <= 1 for s in sizes)
    shards = Counter(r.shard for r in placed.collect())
    assert all(n == 32 for s, n in shards.items() if s < max(shards))


def test_every_slot_is_drawn_once(spark):
    plan = spark.createDataFrame([(0, 7000), (1, 400), (2, 1), (3, 0)], "source_id int, slots long")
    rows = mixing.draw_slots(plan, slots_per_shard=100).collect()
    for s, n in ((0, 7000), (1, 400), (2, 1), (3, 0)):
        assert sorted(r.j for r in rows if r.source_id == s) == list(range(n))
    assert set(Counter(r.shard for r in rows).values()) == {100, 1}
    share = [sum(r.source_id == 1 for r in rows if r.shard == k) for k in range(74)]
    assert max(share) < 20 and min(share) < 6  # spread over the shards, with a multinomial's scatter


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_and_inverse(spark, n):
    key = (F.lit(7), F.lit(3), F.lit(0))
    out = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n).cast("long"), key).alias("p"))
    back = out.select("id", "p", mixing.permuted(F.col("p"), F.lit(n).cast("long"), key, inverse=True).alias("q")).collect()
    assert sorted(r.p for r in back) == list(range(n)) and all(r.q == r.id for r in back)
    assert n < 97 or sum(abs(r.p - r.id) < n / 10 for r in back) < n / 2


def test_mixed_documents_and_empty(docs, no_docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text) for r in out.collect()} <= {(r.doc_id, r.text) for r in docs.collect()}
    assert mixing.mixed_documents(no_docs).count() == 0 and mixing.mix(no_docs)[1].count() == 0
