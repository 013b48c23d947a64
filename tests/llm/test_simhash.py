import random
import re

import xxhash
from pyspark.sql import functions as F

from eligo.llm import simhash
from eligo.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, linked):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if linked(values[a], values[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(values))]


def test_fingerprints_and_components(docs):
    rows = docs.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    root = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {g: min((r.doc_id for r, x in zip(rows, root) if x == g and r.doc_id is not None), default=None) for g in set(root)}
    want = sorted(map(str, ((r.doc_id, f, least[g]) for r, f, g in zip(rows, prints, root))))
    got = simhash.near_duplicates(docs).collect()
    assert sorted(map(str, ((r.doc_id, r.fp % 2**64, r.component_id) for r in got))) == want
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))


def test_search_finds_what_all_pairs_find(spark):
    rng = random.Random(1)
    values = set()
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            values.add(v)
            for _ in range(rng.randrange(1, 6)):
                v ^= 1 << rng.randrange(64)
    values |= {1 << b for b in range(64)} | {0, 2**64 - 1}
    values = sorted(values)
    root = groups(values, lambda a, b: (a ^ b).bit_count() <= 4)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    for tree in (1024, 5):  # whole shards, and shards cut into several trees
        found = {r.node: r.root for r in connected_components(simhash.fingerprint_links(table, tree_size=tree)).collect()}
        label = [found.get(v, v) for v in signed]
        assert len(set(zip(root, label))) == len(set(root)) == len(set(label))


def test_tree_follows_all_edges_within_the_radius():
    rng = random.Random(2)
    values = [rng.getrandbits(10) for _ in range(200)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 1024, 7):
        assert sorted(tree.within(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def test_components_of_a_long_chain_and_a_star(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = links.unionByName(spark.range(1, 400).select(F.lit(1000).alias("a"), (F.col("id") + 1000).alias("b")))
    roots = connected_components(links).collect()
    assert len(roots) == 701 and len({r.root for r in roots}) == 2 and len({r.root for r in roots if r.node <= 300}) == 1


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.deduplicated(no_docs).count() == 0
