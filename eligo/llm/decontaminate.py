"""Benchmark decontamination: item-sized windows found through CGK embedding and bit-sampling LSH.

Texts are sequences of lower-cased (A-Z) words. A CGK walk reads a window from its start: at step j it puts out
the word at its place and moves on by a random bit that depends on j and the word. Two windows a few edits
apart fall out of step at an edit and drift back into step, so a small edit distance becomes a small Hamming
distance of the outputs. An LSH key is the outputs at ``samples`` random steps; ``walks`` independent walks with
``sets`` sample sets each are searched, so that a window within the edit limit shares a key with its item with
at least the target recall (measured in the tests on random edits). Items are classed by length (each class up
to a quarter longer than its shortest), and a class walks 1.5 times its shortest length, so that the embedding
covers the item's size whatever the item.

A copy within k edits of an item has at least the item's length less k words, and at most k words that no item of
the class holds. That test runs on all positions of all documents by one running count, over the shortest length
that a copy of the class can have, and costs no recall; only the positions that pass are embedded. Every candidate
(start, item) is then verified by the exact word edit distance with a free end in the text: the least distance of
the item to the texts of its length less k to its length plus k from there is at most ``1 - similarity`` of the
item's words. (``free_end=False`` of ``find_items`` compares the text of exactly the item's length instead, which
counts a net insertion or deletion twice; no query uses it.)

The items go out in blocks of at most ``block_words`` words, a bound that does not depend on the benchmark's
size; all documents are read against each block. Nothing is shuffled.

Items under ``MIN_WORDS`` words, too short for walks, have an edit limit of 0 or 1. One edit leaves one half of an item as
it is, so the whole item (limit 0) or each half (limit 1) is looked up among all windows of its length by a hash, and
the starts that fit it are verified like any other candidate; this way loses nothing.

Defined cases: null texts have no words; items without a word are not searched; equal items are each reported; a repeated document is reported for each of its rows; an empty
benchmark or table gives no hits. Of several matching windows for an item the one of least distance, then least
start, is reported.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.llm.common import documents, fresh, text_bytes

SIMILARITY = 0.8
MIN_WORDS = 8
WALKS, SETS, SAMPLES = 16, 8, 3
BLOCK_WORDS = 500_000
SEED = 11
CHUNK = 1 << 20  # words handled at a time


def class_of(n: int, least: int = MIN_WORDS) -> tuple[int, int]:
    """(shortest, longest) item length of the class that holds ``n``."""
    lo = least
    while True:
        hi = max(lo, lo * 5 // 4)
        if n <= hi:
            return lo, hi
        lo = hi + 1


def edit_limit(n: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n + 1e-9)


class Words(dict):
    """Numbers of the items' words; any other word is 0."""

    def __missing__(self, word):
        return 0


def sample_steps(lo: int, walk: int, seed: int = SEED, sets: int = SETS, samples: int = SAMPLES) -> np.ndarray:
    """The steps whose outputs make each key of a class, one row per sample set."""
    rng = np.random.default_rng([seed, 1, lo, walk])
    return np.stack([np.sort(rng.choice(lo * 3 // 2, samples, replace=False)) for _ in range(sets)])


def walk_keys(symbols: np.ndarray, starts: np.ndarray, bits: np.ndarray, steps: np.ndarray, salt: int) -> np.ndarray:
    """LSH keys, one row per sample set, of the windows at ``starts``.

    ``bits[i, w]`` holds, one bit per step, the moves of word w in steps 64 i to 64 i + 63.
    """
    wanted = {int(s) for s in steps.ravel()}
    outputs, at = {}, starts.copy()
    for j in range(int(steps.max()) + 1):
        seen = symbols[at]
        if j in wanted:
            outputs[j] = seen
        at += ((bits[j >> 6][seen] >> np.uint64(j & 63)) & np.uint64(1)).astype(at.dtype)
    keys = np.empty((len(steps), len(starts)), np.uint64)
    for t, row in enumerate(steps):
        key = np.full(len(starts), (salt * len(steps) + t) * 0x9E3779B97F4A7C15 & (2**64 - 1), np.uint64)
        for s in row:
            key = (key ^ outputs[int(s)].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            key ^= key >> np.uint64(29)
        keys[t] = key
    return keys


def edit_distance(a: list[int], b: list[int], limit: int) -> int:
    """Edit distance of two word sequences, ``limit + 1`` if over ``limit``."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    over = limit + 1
    row = [j if j <= limit else over for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - limit), min(len(b), i + limit)
        new = [over] * (len(b) + 1)
        if i <= limit:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
        if min(row[lo - 1:hi + 1]) > limit:
            return over
    return min(row[-1], over)


def prefix_distance(item: list[int], text: list[int], limit: int) -> int:
    """Least edit distance of ``item`` to a beginning of ``text``, ``limit + 1`` if over ``limit``."""
    over, n = limit + 1, len(text)
    row = [j if j <= limit else over for j in range(n + 1)]
    for i, x in enumerate(item, 1):
        lo, hi = max(1, i - limit), min(n, i + limit)
        if lo > n + 1:
            return over
        new = [over] * (n + 1)
        if i <= limit:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != text[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
        if min(row[lo - 1:hi + 1]) > limit:
            return over
    return min(min(row), over)


def window_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on."""
    n = max(0, len(symbols) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ symbols[k:k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def short_anchors(coded: list[tuple[int, list[int]]], members: list[int], similarity: float) -> list[tuple]:
    """(size, sorted hashes, item, place in the item, starts beside) of what an unharmed part of a short item looks like."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    for m in members:
        ws = coded[m][1]
        limit, half = edit_limit(len(ws), similarity), len(ws) // 2
        for at, part, beside in [(0, ws, 0)] if not limit else [(0, ws[:half], 0), (half, ws[half:], 1)]:
            key = int(window_hashes(np.array(part, np.int32), len(part))[0])
            found.setdefault(len(part), []).append((key, m, at, beside))
    out = []
    for size, rows in sorted(found.items()):
        rows.sort()
        keys, *rest = zip(*rows)
        out.append((size, np.array(keys, np.uint64), *(np.array(c, np.int64) for c in rest)))
    return out


def short_candidates(symbols: np.ndarray, n: int, anchors: list[tuple]) -> set[tuple[int, int]]:
    """(start, item) of the places where a whole or half short item is found among the first ``n`` words."""
    pairs: set[tuple[int, int]] = set()
    for size, keys, items, places, beside in anchors:
        mine = window_hashes(symbols[:n + size], size)[:n]
        first = np.searchsorted(keys, mine)
        for s in np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == mine).tolist():
            k = int(first[s])
            while k < len(keys) and keys[k] == mine[s]:
                at = s - int(places[k])
                pairs.update((start, int(items[k])) for start in range(at - int(beside[k]), at + int(beside[k]) + 1) if start >= 0)
                k += 1
    return pairs


def build_index(items: list[tuple[int, list[bytes]]], seed: int = SEED, similarity: float = SIMILARITY) -> tuple:
    """Plain data to ship: words, items, per length class its walks and the items' sorted keys, and the short items' anchors."""
    words: dict[bytes, int] = {}
    coded = [(i, [words.setdefault(w, len(words) + 1) for w in ws]) for i, ws in items]
    classes: dict[tuple[int, int], list[int]] = {}
    short = [at for at, (_, ws) in enumerate(coded) if len(ws) < MIN_WORDS]
    for at, (_, ws) in enumerate(coded):
        if len(ws) >= MIN_WORDS:
            classes.setdefault(class_of(len(ws)), []).append(at)
    found = []
    for (lo, hi), members in sorted(classes.items()):
        within = np.zeros(len(words) + 1, bool)
        for m in members:
            within[coded[m][1]] = True
        pad = np.zeros(lo * 3 // 2 + 1, np.int32)
        symbols = np.concatenate([np.concatenate((np.array(coded[m][1], np.int32), pad)) for m in members])
        starts = np.cumsum([0] + [len(coded[m][1]) + len(pad) for m in members[:-1]]).astype(np.int64)
        walks = []
        for w in range(WALKS):
            rng = np.random.default_rng([seed, 0, lo, w])
            bits = rng.integers(0, 2**64, (lo * 3 // 128 + 1, len(words) + 1), np.uint64)
            steps = sample_steps(lo, w, seed)
            keys = walk_keys(symbols, starts, bits, steps, w)
            owner = np.tile(np.array(members, np.int32), len(steps))
            order = np.argsort(keys.ravel(), kind="stable")
            walks.append((bits, steps, keys.ravel()[order], owner[order]))
        found.append((lo, hi, within, walks))
    return words, coded, found, short_anchors(coded, short, similarity)


def find_items(texts: list[bytes], index: tuple, similarity: float = SIMILARITY, free_end: bool = False) -> list[tuple[int, int, int, int]]:
    """(text, item, first word, distance): each text's best window for each item that it holds."""
    words, coded, classes, anchors = index
    number = Words(words).__getitem__
    best: dict[tuple[int, int], tuple[int, int]] = {}
    tried: dict[tuple[int, bytes], int] = {}
    margin = max((hi for _, hi, _, _ in classes), default=MIN_WORDS) * 2 + 2
    blank = [0] * margin  # windows do not run from one text into the next

    def search(symbols: np.ndarray, at: list[int], which: list[int], sizes: list[int]) -> None:
        n = len(symbols) - margin
        for lo, hi, within, walks in classes:
            foreign = np.concatenate(([0], np.cumsum(~within[symbols]))).astype(np.int32)
            if n <= 0:
                continue
            least = lo - edit_limit(lo, similarity) if free_end else lo  # words of the shortest copy
            starts = np.flatnonzero(foreign[least:least + n] - foreign[:n] <= edit_limit(hi, similarity))
            if not len(starts):
                continue
            pairs: set[tuple[int, int]] = set()
            for w, (bits, steps, keys, owner) in enumerate(walks):
                mine = walk_keys(symbols, starts, bits, steps, w)
                first = np.searchsorted(keys, mine)
                hit = np.nonzero(keys[np.minimum(first, len(keys) - 1)] == mine)
                for t, s in zip(*hit):
                    key, k = mine[t, s], int(first[t, s])
                    while k < len(keys) and keys[k] == key:
                        pairs.add((int(starts[s]), int(owner[k])))
                        k += 1
            verify(pairs, symbols, at, which, sizes)
        if anchors and n > 0:
            verify(short_candidates(symbols, n, anchors), symbols, at, which, sizes)

    def verify(pairs: set[tuple[int, int]], symbols: np.ndarray, at: list[int], which: list[int], sizes: list[int]) -> None:
        for s, item in sorted(pairs):
            ws = coded[item][1]
            text = bisect_left(at, s + 1) - 1
            if s >= at[text] + sizes[text]:
                continue
            limit = edit_limit(len(ws), similarity)
            window = symbols[s:min(s + len(ws) + (limit if free_end else 0), at[text] + sizes[text])]
            content = (item, window.tobytes())
            d = tried.get(content)
            if d is None:
                d = prefix_distance(ws, window.tolist(), limit) if free_end else edit_distance(window.tolist(), ws, limit)
                if len(tried) < 100_000:
                    tried[content] = d
            if d <= limit:
                place = (d, s - at[text])
                key = (which[text], item)
                best[key] = min(best.get(key, place), place)

    buffer: list[int] = []
    at: list[int] = []
    which: list[int] = []
    sizes: list[int] = []
    for t, text in enumerate(texts):
        ws = text.lower().split()
        if ws:
            at.append(len(buffer))
            which.append(t)
            sizes.append(len(ws))
            buffer.extend(map(number, ws))
            buffer.extend(blank)
        if buffer and (len(buffer) > CHUNK or t == len(texts) - 1):
            search(np.array(buffer, np.int32), at, which, sizes)
            buffer, at, which, sizes = [], [], [], []
    if buffer:
        search(np.array(buffer, np.int32), at, which, sizes)
    return [(t, coded[item][0], s, d) for (t, item), (d, s) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, min_words: int = 1, block_words: int = BLOCK_WORDS) -> Iterator[list]:
    """The benchmark's items (id, words) in blocks of a bounded number of words."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_bytes().alias("text")).orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        words = bytes(row["text"]).lower().split()
        if len(words) < min_words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row["item_id"], words))
        size += len(words)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = 1) -> DataFrame:
    """(doc_id, item_id, start_word, distance) for every document row and item that it holds."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    schema = "doc_id long, item_id long, start_word long, distance long"
    out = None
    for block in item_blocks(benchmark, min_words):
        index = spark.sparkContext.broadcast(build_index(block, similarity=similarity))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = find_items([t.as_py() for t in batch.column(1)], index.value, similarity, free_end=True)
                if hits:
                    which, *rest = zip(*hits)
                    yield pa.record_batch([batch.column(0).take(pa.array(which)), *[pa.array(c, pa.int64()) for c in rest]],
                                          ["doc_id", "item_id", "start_word", "distance"])

        one = rows.mapInArrow(run, schema)
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = 1) -> DataFrame:
    """The documents that hold no item; the rows go by once per block and are not shuffled."""
    from pyspark.sql import types as T
    spark, out = docs.sparkSession, docs
    name = fresh(docs, "_text")
    for block in item_blocks(benchmark, min_words):
        index = spark.sparkContext.broadcast(build_index(block, similarity=similarity))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = find_items([t.as_py() for t in batch.column(batch.num_columns - 1)], index.value, similarity, free_end=True)
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in hits]] = False
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(keep))

        out = out.select(*[out[c] for c in docs.columns], text_bytes().alias(name)).mapInArrow(run, T.StructType(docs.schema.fields))
    return out


def op7_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
