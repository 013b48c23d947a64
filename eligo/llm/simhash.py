"""SimHash near-duplicates: fingerprints linked through BK-trees, groups as connected components.

Fingerprint: the lower-cased (A-Z) words' 4-word shingles, repeats included, are hashed with XXH64 (seed 42);
a bit is 1 if it is set in over half of the hashes. Documents with the same fingerprint are one class, so
only distinct fingerprints are searched.

Search: fingerprints that differ in at most ``radius`` bits agree on at least two of six bit blocks (for
radius 4: four differing bits touch at most four blocks). For each of the 15 pairs of blocks the fingerprints
that agree there form a shard. A shard's BK-tree keys the children of a node by their Hamming distance to
it, and a search follows only the edges whose key is within the radius of the query's distance. A shard over
``tree_size`` members is cut into trees of about that size, and each tree is sent to every part of the
shard's queries once (unit (i, j): the tree of part i, the queries of part j), so no task gets a whole hot
shard. The bound on a tree, and so on what is shipped, is the parameter. Trees are shipped by the shuffle to
the tasks that hold matching queries and not to every executor: over all fingerprints a tree barely prunes
(random 64-bit values lie about 32 bits apart, so a radius-4 search would visit most nodes), and the work
would grow with the square of the corpus.

A unit reports a spanning set of its links (one per member and group at most), which keeps every component.

Defined cases: a null or blank text has fingerprint 0 and links like any other; a null ``doc_id`` takes part
and is passed over in the smallest id (a component of nulls alone has a null id); repeated rows share their
fingerprint; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.llm.common import documents, fresh, materialize, text_bytes
from eligo.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
TREE = 1024      # fingerprints in a tree, on average
CHUNK = 1 << 16  # shingles hashed at a time


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of one text."""
    words = text.lower().split()  # bytes.lower maps A-Z alone
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        return np.uint64(xxhash.xxh64_intdigest(joined, 42)).astype(np.int64).item()
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        to = min(total, at + CHUNK)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1:to + width - 1].tolist())
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, row: str | None = None) -> DataFrame:
    """(row, doc_id, fp) for every document, written once to the shared folder.

    ``row`` tells rows with one id apart: the column ``row`` names, or a number made here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), width) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["row", "doc_id", "fp"])

    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return materialize(rows.mapInArrow(run, "row long, doc_id long, fp long"), "fingerprints")


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Masks of the (blocks - radius)-subsets of the bit blocks, as signed 64-bit integers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    masks = (sum(c) for c in combinations(parts, blocks - radius))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class BKTree:
    """Children of a node are keyed by their Hamming distance to it."""

    def __init__(self):
        self.root = None  # [value, {distance: node}]

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if not d:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            d = (node[0] ^ value).bit_count()
            if d <= radius:
                found.append(node[0])
            stack.extend(child for key, child in node[1].items() if d - radius <= key <= d + radius)
        return found


def spanning_links(tree_values: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """Links between queries and tree members that join the same groups as all of them would."""
    tree = BKTree()
    for v in tree_values:
        tree.add(v)
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    links = []
    for q in queries:
        for v in tree.within(q, radius):
            a, b = find(q), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((q, v))
    return links


def _search_units(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of the units in a partition sorted by unit; a unit is bounded, rows of other units are not held."""

    def flush(fps: list, parts: list, i: int, j: int, out: list) -> None:
        if i == j:
            found = spanning_links(fps, fps, radius) if len(fps) > 1 else []
        else:
            found = spanning_links([f for f, p in zip(fps, parts) if p == i], [f for f, p in zip(fps, parts) if p == j], radius)
        out.extend(found)

    def signed(out: list) -> pa.RecordBatch:
        ends = np.array(out, dtype=np.uint64).view(np.int64)
        return pa.record_batch([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    key, fps, parts = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in range(6)]  # t, k, i, j, part, fp
        changed = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
        bounds = np.concatenate(([0], changed, [batch.num_rows]))
        out: list = []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            this = tuple(int(c[s]) for c in cols[:4])
            if this != key:
                if len(fps) > 1:
                    flush(fps, parts, key[2], key[3], out)
                key, fps, parts = this, [], []
            fps.extend(cols[5][s:e].view(np.uint64).tolist())  # unsigned: bit_count of a negative int differs
            parts.extend(cols[4][s:e].tolist())
        if out:
            yield signed(out)
    out = []
    if len(fps) > 1:
        flush(fps, parts, key[2], key[3], out)
    if out:
        yield signed(out)


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tree_size: int = TREE) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that join the same groups as all links would."""
    masks = block_masks(blocks, radius)
    shards = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                                 for t, m in enumerate(masks)])).alias("s")
    members = distinct.select("fp", shards).select("s.t", "s.k", "fp")
    large = (members.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tree_size)
             .select("t", "k", F.ceil(F.col("n") / tree_size).cast("int").alias("trees")))
    cut = (members.join(large, ["t", "k"], "left").na.fill(1, ["trees"])
           .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("trees") - 1))))
    units = cut.select("t", "k", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "fp")
    units = units.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    return units.mapInArrow(lambda it: _search_units(it, radius), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, row: str | None = None) -> DataFrame:
    """(row, doc_id, fp, component_id, root): every document with its fingerprint, its group's smallest id and
    one of the group's fingerprints."""
    rows = fingerprints(docs, width, row)
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), radius))
    joined = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Stored: a join that reads it through an exchange of its own can be split where one group is large.
    least = materialize(joined.groupBy("root").agg(F.min("least").alias("component_id")), "fingerprint-least")
    named = materialize(joined.join(least, "root").select("fp", "component_id", "root"), "fingerprint-groups")
    return rows.join(named, "fp").select("row", "doc_id", "fp", "component_id", "root")


def deduplicated(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents less near-copies: of each group one stays, with the smallest id (null last, then any one).

    The documents are numbered and written once first, so that the rows found are the rows kept.
    """
    name, kept = fresh(docs, "_row"), fresh(docs, "_kept")
    numbered = materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered-documents")
    found = near_duplicates(numbered, width, radius, name)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    keep = found.groupBy("root").agg(F.min(first)["row"].alias("least")).select(F.col("least").alias(kept))
    return numbered.join(keep, F.col(name) == F.col(kept), "left_semi").select(*[numbered[c] for c in docs.columns])


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
