"""Substring dedup on paragraphs: MinHash bands, exact verification, clusters by components.

Paragraphs are cut at line ends and at sentence ends within a line, so that a passage pasted into the middle of
a line is whole paragraphs again; a run of over 40 words without either is cut after words whose checksum is a
multiple of 16 (after 64 words at the latest), which falls alike in every copy. Paragraphs are compared by their
lower-cased (A-Z) words. Consecutive paragraphs under 8 words are merged, by content, until they have 8; what stays
under 8 words is compared exactly, together with the 8 words before it or the 8 after it, as it tells little alone.

Whole lines of 8 words or more are compared as well, with each other: one changed word costs 5 shingles, so that
only a unit of some 50 words or more can be a near-copy with an edit inside, and a line keeps what its paragraphs
divide; the paragraphs find what is pasted from one line into another. Below, a unit is a line or a paragraph.

Equal paragraphs form a class. Two different ones are linked if the Jaccard similarity of their sets of 5-word
shingles is 0.8 or more. Every class gets MinHash bands: 5 bands of 2 rows put a pair of similarity 0.8 into a
common bucket with probability 1 - 0.36**5 = 0.994. Paragraphs that share a bucket are verified by the exact
similarity of their shingle sets. A bucket of more than ``block`` classes is cut into blocks, and every pair of
blocks is compared in a task of its own; within a task pairs that are already joined are passed over, which
changes no component.

The texts are scanned twice. The first scan passes on 32 bits of each digest, and of each band key with 32 bits of the
digest that has it, packed by slice of the key space; a task passes on two holders of a key at most. Digests met twice
and band keys met under different digests go into a Bloom filter, 16 bits for each of them (up to ``FILTER_BITS`` in all).
The second scan shuffles only units whose digest or a band key is in the filter, with those band keys and, for one copy
a task, the words. A key that the filter has by accident adds rows that later steps drop, and none is missing. The keys,
and not places in the scan, tie the two scans together, so it does not matter how the files are dealt to tasks, or
whether that changes when executors are lost.

Of the copies that a task sees of one unit only the first travels under its digest: the others point to it (a fixed
number of digests is remembered; beyond it copies are shuffled like any), so a line that many documents share reaches
the task that gathers its class once per task that read it.

Clusters are the components of those links. The first paragraph of a cluster (by document id, null last, then
place) stays, and the others are removed. Lines are settled first, and of a cluster of paragraphs the first one
that is not part of a removed line stays. ``shared_passages`` does both levels (the query); ``shared_paragraphs``
compares paragraphs alone.

Defined cases: a null or blank text has no paragraphs; repeats within one document are removed like any; a null
``doc_id`` takes part, and all null ids count as one document; rows that share an id are reported together;
an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, compress, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.llm.common import documents, materialize, text_bytes, worker_cache
from eligo.llm.components import connected_components
from eligo.llm.ppm import _release

MIN_WORDS = 8
WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 5, 2
BLOCK = 256
LONG_RUN, LAST_CUT, CUT_EVERY = 40, 64, 16  # words
SEED = 5
REMEMBERED = 500_000
LINE_MARK = 0x5851F42D4C957F2D  # keeps the buckets of lines apart
FILTER_BITS = 1 << 30  # of the filter of wanted keys at most
SLICES = 8  # of the key space for each shuffle partition
PACKED = 200_000  # units whose keys are packed at a time
PROBES = tuple(np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64))
LOW = np.uint64(2**32 - 1)

_BREAK = re.compile(rb"[.!?\n](?:(?<=\n)|[ \t\x0b\x0c\r]+)")  # one set of first bytes: the search skips to them
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class CutWord(dict):
    """Whether a long run is cut after the word."""

    def __missing__(self, word: bytes) -> bool:
        cut = zlib.crc32(word) % CUT_EVERY == 0
        if len(self) < REMEMBERED:
            self[word] = cut
        return cut


def _cuts():
    return worker_cache().setdefault("cut-words", CutWord()).__getitem__


def paragraph_spans(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of the text's paragraphs, in order; what lies between them is white space."""
    out, at = [], 0
    for start, after in [*map(re.Match.span, _BREAK.finditer(text)), (len(text), len(text))]:
        end = start + 1 if start < after and text[start] != 10 else start
        if text.count(b" ", at, end) < LONG_RUN:
            if at < end and not text[at:end].isspace():
                out.append((at, end))
        else:
            piece = text[at:end]
            words = [w.span() for w in _WORD.finditer(piece)]
            first = 0
            for n in [*compress(count(1), map(_cuts(), piece.lower().split())), len(words)]:
                while n - first > LAST_CUT:
                    out.append((at + words[first][0], at + words[first + LAST_CUT - 1][1]))
                    first += LAST_CUT
                if n > first:
                    out.append((at + words[first][0], at + words[n - 1][1]))
                    first = n
        at = after
    return out


def _hashes() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 2**63, (2, WIDTH), np.uint64) | np.uint64(1), rng.integers(0, 2**64, (BANDS * ROWS, 2), np.uint64) | np.uint64(1)


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = h
        return h


def band_keys(words: list[bytes], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bucket keys of the stretches ``start`` to ``end`` (of WIDTH words at least) of the words: a row per stretch and a
    column per band. Stretches may overlap: each window of words is hashed once."""
    number = worker_cache().setdefault("word-hash", WordHash()).__getitem__
    mix, perms = _hashes()
    hashed = np.fromiter(map(number, words), np.uint64, len(words))
    hashed ^= hashed >> np.uint64(31)
    n = len(words) - WIDTH + 1
    grams = np.zeros(n + 1, np.uint64)  # the last one is for stretches to end at
    for i in range(WIDTH):
        grams[:n] += hashed[i:n + i] * mix[0, i]
    places = np.stack([start, end - WIDTH + 1], 1).ravel()
    lows = np.empty((BANDS * ROWS, len(start)), np.uint64)
    for k, (a, b) in enumerate(perms):
        x = grams * a
        x += b
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(29)
        lows[k] = np.minimum.reduceat(x, places)[::2]
    keys = np.empty((len(start), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(start), band + 1, np.uint64)
        for r in range(ROWS):
            key = (key ^ lows[band * ROWS + r]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        keys[:, band] = key
    return keys


def shingles(words: list[bytes]) -> frozenset:
    return frozenset(zip(*(words[i:] for i in range(WIDTH))))


class Unit(NamedTuple):
    """A stretch of a text that is compared: paragraphs ``pos`` to ``pos + size``, words ``start`` to ``end``."""

    pos: int
    size: int
    start: int
    end: int
    line: int            # place of its line in the text's list of units; its own for a line, -1 for none


def merged(words: list[list[bytes]], first: int, end: int) -> list[tuple[int, int]]:
    """The run of short paragraphs ``first`` to ``end`` in stretches of MIN_WORDS words at least, or whole if it has fewer
    than twice as many.

    A stretch ends with a paragraph whose checksum is the least of all whose ends lie within MIN_WORDS words of its own,
    so copies are cut alike whatever stands around them; after LAST_CUT words without one it ends anyway.
    """
    ends = list(accumulate(len(words[i]) for i in range(first, end)))
    if ends[-1] < 2 * MIN_WORDS:
        return [(first, end)]
    marks = [zlib.crc32(b" ".join(words[i])) for i in range(first, end)]
    out, at, used = [], 0, 0
    for i, n in enumerate(ends):
        if ends[-1] - n < MIN_WORDS:
            break
        if n - used < MIN_WORDS:
            continue
        left, right = i - 1, i + 1
        while left >= 0 and n - ends[left] < MIN_WORDS and marks[left] > marks[i]:
            left -= 1
        while right < len(ends) and ends[right] - n < MIN_WORDS and marks[right] >= marks[i]:
            right += 1
        least = (left < 0 or n - ends[left] >= MIN_WORDS) and (right == len(ends) or ends[right] - n >= MIN_WORDS)
        if least or n - used >= LAST_CUT:
            out.append((first + at, first + i + 1))
            at, used = i + 1, n
    return [*out, (first + at, end)]


def text_units(spans: list[tuple[int, int]], words: list[list[bytes]], text: bytes) -> list[Unit]:
    """The units of a text: every line of MIN_WORDS words, each followed by its paragraphs, and the shorter lines. Short
    paragraphs are merged with those beside them: within their line, or with other short lines."""
    out: list[Unit] = []
    starts = [0, *accumulate(map(len, words))]

    def add(first: int, end: int, line: int) -> None:
        """The paragraphs ``first`` to ``end``, the short ones merged."""
        i = first
        while i < end:
            j = i
            while j < end and len(words[j]) < MIN_WORDS:
                j += 1
            j = max(j, i + 1)
            for a, b in merged(words, i, j) if starts[j] - starts[i] >= 2 * MIN_WORDS and len(words[i]) < MIN_WORDS else [(i, j)]:
                out.append(Unit(a, b - a, starts[a], starts[b], line))
            i = j

    at = waiting = 0  # lines from ``waiting`` on are short
    while at < len(spans):
        end = at + 1
        while end < len(spans) and text.find(b"\n", spans[end - 1][1], spans[end][0]) < 0:
            end += 1
        if starts[end] - starts[at] >= MIN_WORDS:
            add(waiting, at, -1)
            out.append(Unit(at, end - at, starts[at], starts[end], len(out)))
            add(at, end, len(out) - 1)
            waiting = end
        at = end
    add(waiting, at, -1)
    return out


def short_keys(words: list[bytes], start: int, end: int) -> list[bytes]:
    """What a short unit is known by: itself with the MIN_WORDS words before it, and with those after it; with all of a
    text that has too few words for either."""
    own, before, after = (b" ".join(words[i:j]) for i, j in ((start, end), (max(0, start - MIN_WORDS), start), (end, end + MIN_WORDS)))
    keys = [before + b"\n\n" + own] if start >= MIN_WORDS else []
    keys += [own + b"\n\n\n" + after] if end + MIN_WORDS <= len(words) else []
    return keys or [before + b"\n\n" + own + b"\n\n" + after]


class Cut(NamedTuple):
    """Units of some texts, a row each; a short unit has a row for each of its keys. The numbers start from the partition's
    index and name a row within one job."""

    uid: np.ndarray
    n_words: np.ndarray
    digests: list[bytes]
    bands: np.ndarray    # zeros for short units
    doc: list
    pos: list[int]
    up: list[int]        # distance to the number of the unit's line, or -1
    size: list[int]      # paragraphs
    again: list[bool]    # the row before is of the same unit
    body: list           # the words; none for short units


def _units(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[Cut]:
    """A partition's units, some at a time: those of ``text_units``, or else its paragraphs of MIN_WORDS words at least."""
    base = TaskContext.get().partitionId() << 40
    rows: list[tuple] = []
    flat: list[bytes] = []

    def taken() -> Cut:
        nonlocal base, rows, flat
        start, end, line, digests, *rest = zip(*rows)
        start, end = np.array(start), np.array(end)
        bands = np.zeros((len(rows), BANDS), np.uint64)
        long = np.flatnonzero(end - start >= MIN_WORDS)
        if len(long):
            bands[long] = band_keys(flat, start[long], end[long])
            bands[np.array(line)] ^= np.uint64(LINE_MARK)
        out = Cut(np.arange(base, base + len(rows)), end - start, digests, bands, *rest)
        base, rows, flat = base + len(rows), [], []
        return out

    digest = xxhash.xxh3_128_digest
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            spans, lower = paragraph_spans(text), text.lower()
            parts = [lower[s:e].split() for s, e in spans]
            words = [w for part in parts for w in part]
            joined, at = b" ".join(words), [0, *accumulate(map(len, words))]  # ends of the words, without the blanks
            if whole:
                units = text_units(spans, parts, text)
            else:
                ends = list(accumulate(map(len, parts)))
                units = [Unit(p, 1, e - len(w), e, -1) for p, (e, w) in enumerate(zip(ends, parts)) if len(w) >= MIN_WORDS]
            line, off = 0, len(flat)  # row of the line, place of the text's words
            for k, (pos, size, start, end, of) in enumerate(units):
                if end - start < MIN_WORDS:
                    up = len(rows) - line if of >= 0 else -1
                    for n, key in enumerate(short_keys(words, start, end)):
                        rows.append((off + start, off + end, False, digest(key), i, pos, up + n if up >= 0 else -1, size, n > 0, None))
                    continue
                body = joined[at[start] + start:at[end] + end - 1]
                # Lines are compared with lines, paragraphs with paragraphs: a line is no copy of its own paragraph.
                if of == k:
                    line = len(rows)
                    rows.append((off + start, off + end, True, digest(b"\n" + body), i, pos, 0, size, False, body))
                else:
                    rows.append((off + start, off + end, False, digest(body), i, pos, len(rows) - line if of >= 0 else -1, size, False, body))
            flat += words
            if len(rows) >= 4_000:
                yield taken()
    if rows:
        yield taken()


def _place(keys: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """The slice that a key is in, and the 32 bits that stand for it there."""
    return (keys >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32), keys & LOW


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The values between the cuts, as binaries."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _keys(batches: Iterator[pa.RecordBatch], whole: bool, slices: int) -> Iterator[pa.RecordBatch]:
    """(slice, digests, bands): the keys of a partition's units by slice, two holders of a key at most. Digests as 32 bits,
    band keys as 32 bits above 32 bits of the other half of the digest."""
    held: list[tuple] = []

    def packed() -> pa.RecordBatch:
        d, bands, banded = (np.concatenate(x) for x in zip(*held))
        held.clear()
        own, first, count = np.unique(d[:, 0], return_index=True, return_counts=True)
        own = np.repeat(own, np.minimum(count, 2))
        first = first[banded[first]]
        keys = bands[first].ravel()
        order = np.argsort(keys)
        keys, tags = keys[order], np.repeat(d[first, 1] & LOW, BANDS)[order]
        some = np.ones(len(keys), bool)
        some[2:] = keys[2:] != keys[:-2]
        edges, columns = np.arange(slices + 1), []
        for k, tag in ((own, None), (keys[some], tags[some])):
            part, low = _place(k, slices)
            columns.append(_packed(low.astype("<u4") if tag is None else (low << np.uint64(32) | tag).astype("<u8"), np.searchsorted(part, edges)))
        batch = pa.record_batch([pa.array(np.arange(slices, dtype=np.int32)), *columns], ["slice", "digests", "bands"])
        return batch.filter(pa.array(np.any([pa.compute.binary_length(c).to_numpy() > 0 for c in columns], axis=0)))

    for c in _units(batches, whole):
        held.append((np.frombuffer(b"".join(c.digests), "<u8").reshape(-1, 2), c.bands, c.n_words >= MIN_WORDS))
        if sum(len(x[2]) for x in held) >= PACKED:
            yield packed()
    if held:
        yield packed()


def _repeated(rows: pa.Table) -> pa.Table:
    """(slice, keys, n): the digests of a slice that come twice, and the band keys that come with different digests."""
    digests = np.sort(np.frombuffer(b"".join(rows.column("digests").to_pylist()), "<u4"))
    bands = np.unique(np.frombuffer(b"".join(rows.column("bands").to_pylist()), "<u8")) >> np.uint64(32)
    twice = np.unique(np.concatenate([x[1:][x[1:] == x[:-1]] for x in (digests, bands)]).astype("<u4"))
    return pa.table({"slice": rows.column("slice").slice(0, 1), "keys": pa.array([twice.tobytes()], pa.binary()), "n": pa.array([len(twice)], pa.int64())})


def _bit(low: np.ndarray, size: int, probe: int) -> np.ndarray:
    return (((low + np.uint64(1)) * PROBES[probe] >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def _filters(batches: Iterator[pa.RecordBatch], size: int, probes: int) -> Iterator[pa.RecordBatch]:
    """Bloom filters of ``size`` bits, one per slice."""
    for batch in batches:
        out = []
        for keys in batch.column(1).to_pylist():
            low, bits = np.frombuffer(keys, "<u4").astype(np.uint64), np.zeros(size, bool)
            for probe in range(probes):
                bits[_bit(low, size, probe)] = True
            out.append(np.packbits(bits, bitorder="little").tobytes())
        yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["slice", "bits"])


def wanted_keys(rows: DataFrame, whole: bool, bits: int = FILTER_BITS) -> tuple[np.ndarray, int, int, int]:
    """The filter (bits, slices, bits of a slice, probes) of the digests and band keys that several units share."""
    spark = rows.sparkSession
    slices = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    repeated = materialize(rows.mapInArrow(lambda it: _keys(it, whole, slices), "slice int, digests binary, bands binary")
                           .groupBy("slice").applyInArrow(_repeated, "slice int, keys binary, n long"), "paragraph-keys")
    _release(spark)
    n = repeated.agg(F.sum("n")).first()[0] or 0
    size = max(64, min(bits, 16 * n) // slices // 8 * 8)
    probes = max(1, min(len(PROBES), round(.7 * size * slices / max(n, 1))))
    table = repeated.select("slice", "keys").mapInArrow(lambda it: _filters(it, size, probes), "slice int, bits binary").toArrow()
    out = np.zeros((slices, size // 8), np.uint8)
    for k, x in zip(table.column("slice").to_pylist(), table.column("bits")):
        out[k] = np.frombuffer(x.as_py(), np.uint8)
    return out.ravel(), slices, size, probes


def in_filter(keys: np.ndarray, wanted: tuple[np.ndarray, int, int, int]) -> np.ndarray:
    bits, slices, size, probes = wanted
    (part, low), left = _place(keys, slices), np.arange(len(keys))
    part = part.astype(np.int64) * size
    for probe in range(probes):
        at = part + _bit(low, size, probe)
        hit = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
        part, low, left = part[hit], low[hit], left[hit]
    out = np.zeros(len(keys), bool)
    out[left] = True
    return out


UNITS = "d1 long, d2 long, uid long, rep long, doc_id long, pos int, n_words int, bands array<long>, up int, size int, again boolean, body binary"


def _cut(batches: Iterator[pa.RecordBatch], whole: bool = False, wanted=None) -> Iterator[pa.RecordBatch]:
    """Digest, band keys and words of each unit with a key in the filter (of all without one); a copy of an earlier one of
    this task names that one as ``rep``.

    Copies travel under their ``rep`` instead of the digest (d2 is null), so they do not meet in one task.
    """
    first: dict[bytes, int] = {}
    for c in _units(batches, whole):
        d = np.frombuffer(b"".join(c.digests), "<i8").reshape(-1, 2)
        shared = np.repeat(c.n_words[:, None] >= MIN_WORDS, BANDS, 1)  # band keys
        keep = np.arange(len(d))
        if wanted is not None:
            shared &= in_filter(c.bands.ravel(), wanted.value).reshape(shared.shape)
            keep = np.flatnonzero(shared.any(1) | in_filter(d[:, 0].view(np.uint64), wanted.value))
        if not len(keep):
            continue
        places, uid, d, rep = keep.tolist(), c.uid[keep], d[keep], []
        for u, i in zip(uid.tolist(), places):
            r = first.get(c.digests[i])
            if r is None:
                r = u
                if len(first) < REMEMBERED:
                    first[c.digests[i]] = u
            rep.append(r)
        rep = np.array(rep)
        own = rep == uid
        shared = shared[keep] & own[:, None]
        near = shared.any(1)
        ends = np.concatenate([[0], np.cumsum(shared.sum(1))]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(c.bands[keep][shared].view(np.int64)), mask=pa.array(~near))
        of = lambda col, kind: pa.array([col[i] for i in places], kind)
        yield pa.record_batch(
            [pa.array(np.where(own, d[:, 0], rep)), pa.array(d[:, 1], mask=~own), pa.array(uid), pa.array(rep), of(c.doc, pa.int64()),
             of(c.pos, pa.int32()), pa.array(c.n_words[keep].astype(np.int32)), bands, of(c.up, pa.int32()), of(c.size, pa.int32()),
             of(c.again, pa.bool_()), pa.array([c.body[i] if x else None for i, x in zip(places, near.tolist())], pa.binary())],
            [f.split()[0] for f in UNITS.split(", ")])


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of a sorted partition with, for each row: its number in its run of equal keys, whether the run
    goes on after it, and whether it is the first of its run. The last row of a batch waits for the next one."""
    held, key, number = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        held = batch.slice(batch.num_rows - 1, 1)
        if batch.num_rows > 1:
            out, number, key = _number(batch, keys, number, key, True)
            yield out
    if held is not None:
        out, _, _ = _number(held, keys, number, key, False)
        yield out


def _number(batch: pa.RecordBatch, keys: int, number: int, key: tuple | None, more: bool):
    cols = [batch.column(c).to_numpy() for c in range(keys)]
    n = batch.num_rows
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    new[0] = key is None or key != tuple(int(c[0]) for c in cols)
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(new, at, -1))
    numbers = np.where(start >= 0, at - start, at + number)
    if more:  # the last row comes again with the next batch
        goes_on = ~new[1:]
        prev = tuple(int(c[n - 2]) for c in cols)
        return (batch.slice(0, n - 1), numbers[:-1], goes_on, new[:-1]), int(numbers[n - 2]) + 1, prev
    return (batch, numbers, np.zeros(n, bool), new), 0, None


CLASSES = "cid long, uid long, rep long, doc_id long, pos int, n_words int, many boolean, bands array<long>, up int, size int, again boolean, body binary"


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by digest with their class (its first row's number); band keys and words stay on that row."""
    names = [f.split()[0] for f in CLASSES.split(", ")]

    def leaders() -> Iterator[pa.RecordBatch]:
        """Rows under their digest; the others pass by."""
        for batch in batches:
            own = batch.column(1).is_valid()
            copies = batch.filter(pa.compute.invert(own))
            if copies.num_rows:
                n = copies.num_rows
                passed.append(pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), *[copies.column(c) for c in (2, 3, 4, 5, 6)], pa.array([True] * n), pa.nulls(n, pa.list_(pa.int64())),
                     *[copies.column(c) for c in (8, 9, 10)], pa.nulls(n, pa.binary())], names=names))
            yield batch.filter(own)

    passed: list[pa.RecordBatch] = []
    cid = 0
    for batch, number, goes_on, _ in _runs(leaders(), 2):  # the columns of UNITS
        yield from passed
        passed.clear()
        uid, lead = batch.column(2).to_numpy(), number == 0
        first = np.maximum.accumulate(np.where(lead, np.arange(len(number)), -1))
        cids = np.where(first >= 0, uid[np.maximum(first, 0)], cid)
        cid = int(cids[-1])
        leading = pa.array(np.arange(batch.num_rows), mask=~lead)
        yield pa.RecordBatch.from_arrays([pa.array(cids), *[batch.column(c) for c in (2, 3, 4, 5, 6)], pa.array(~lead | goes_on), batch.column(7).take(leading),
                                          *[batch.column(c) for c in (8, 9, 10)], batch.column(11).take(leading)], names=names)
    yield from passed


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, cid) sorted by key: those whose bucket holds several, numbered within it."""
    for batch, number, goes_on, _ in _runs(batches, 1):
        keep = pa.array((number > 0) | goes_on)
        out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(number.astype(np.int64))], names=["key", "cid", "place"]).filter(keep)
        if out.num_rows:
            yield out


def similar_links(left: list[tuple[int, frozenset]], right: list[tuple[int, frozenset]] | None,
                  similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links of at least ``similarity`` within ``left``, or between both, that join the same groups as all would."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    links = []
    for n, (a, sa) in enumerate(left):
        for b, sb in (left[n + 1:] if right is None else right):
            if a == b or min(len(sa), len(sb)) < similarity * max(len(sa), len(sb)) or find(a) == find(b):
                continue
            both = len(sa & sb)
            if both >= similarity * (len(sa) + len(sb) - both) - 1e-9:
                parent[find(a)] = find(b)
                links.append((a, b))
    return links


def _verify(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Links of the units (key, i, j) in a sorted partition; a unit holds two blocks at most."""
    key, rows = None, []

    def flush() -> list[tuple[int, int]]:
        members = [(cid, part, shingles(body.split())) for cid, part, body in rows]
        if key[1] == key[2]:
            return similar_links([(c, s) for c, _, s in members], None, similarity)
        return similar_links([(c, s) for c, p, s in members if p == key[1]], [(c, s) for c, p, s in members if p == key[2]], similarity)

    for batch in batches:
        out: list = []
        for k, i, j, part, cid, body in zip(*(c.to_pylist() for c in batch.columns)):
            if (k, i, j) != key:
                if len(rows) > 1:
                    out += flush()
                key, rows = (k, i, j), []
            rows.append((cid, part, body))
        if out:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])
    out = flush() if len(rows) > 1 else []
    if out:
        yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])


def near_links(rows: DataFrame, classes: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(a, b): verified links between classes, enough to join every group. ``rows``, (doc_id, text), are those that the
    classes come from; they are not read again, as the classes hold their words."""
    firsts = classes.filter(F.col("bands").isNotNull())  # one row per class of units that may have a near-copy
    keyed = firsts.select(F.explode("bands").alias("key"), "cid")
    found = materialize(keyed.repartition("key").sortWithinPartitions("key", "cid")
                        .mapInArrow(_buckets, "key long, cid long, place long"), "paragraph-buckets")
    large = found.filter(F.col("place") >= block).groupBy("key").agg(F.max("place").alias("last"))
    cut = (found.join(large.select("key", F.expr(f"cast(last div {block} as int)").alias("blocks")), "key", "left").na.fill(0, ["blocks"])
           .withColumn("part", F.expr(f"cast(place div {block} as int)"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks")))))
    units = (cut.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "cid")
             .join(firsts.select("cid", "body"), "cid").select("key", "i", "j", "part", "cid", "body"))
    return (units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(lambda it: _verify(it, similarity), "a long, b long"))


def _members(docs: DataFrame, similarity: float, whole: bool) -> DataFrame:
    """(cid, uid, doc_id, pos, n_words, up, size, again, root) of every unit in a cluster of several."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    wanted = docs.sparkSession.sparkContext.broadcast(wanted_keys(rows, whole))
    units = rows.mapInArrow(lambda it: _cut(it, whole, wanted), UNITS)
    classes = materialize(units.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "uid")
                          .mapInArrow(_classes, CLASSES), "paragraph-classes")
    _release(docs.sparkSession)
    roots = connected_components(near_links(rows, classes, similarity)).select(F.col("node").alias("cid"), "root")
    _release(docs.sparkSession)
    leaders, columns = classes.filter("rep = uid"), ["cid", "uid", "doc_id", "pos", "n_words", "up", "size", "again"]
    copies = materialize(classes.filter("rep <> uid").drop("cid").join(leaders.select(F.col("uid").alias("rep"), "cid"), "rep")
                         .select(*columns), "paragraph-copies")
    # Classes to report besides those of several leaders: with copies within a task, or linked to others.
    more = roots.unionByName(copies.select("cid", F.lit(None).cast("long").alias("root"))).groupBy("cid").agg(F.max("root").alias("root"))
    more = materialize(more.withColumn("found", F.lit(True)), "paragraph-more")
    members = leaders.join(more, "cid", "left").filter("many or found").select(*columns, "root").unionByName(
        copies.join(more, "cid", "left").select(*columns, "root"))
    return materialize(members.withColumn("root", F.coalesce("root", "cid")), "paragraph-members")


def _judged(members: DataFrame) -> DataFrame:
    """The members with their cluster, whether it spans several documents, and whether another member stays for them.

    A member whose line is removed (``gone``) stays for others only if there is none besides.
    """
    first = F.struct("gone", F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("pos"), F.col("uid"))
    groups = materialize(members.groupBy("root").agg(
        F.min(first).alias("f"), ((F.min("doc_id") != F.max("doc_id")) | (F.count("doc_id").between(1, F.count(F.lit(1)) - 1))).alias("spans")),
        "paragraph-groups")
    return members.join(groups, "root").select(
        *members.columns, F.col("f.doc_id").alias("cluster"), F.coalesce("spans", F.lit(False)).alias("spans"),
        (F.col("uid") != F.col("f.uid")).alias("removed"))


def shared_paragraphs(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, pos, n_words, cluster, spans, removed) of every paragraph in a cluster of several, paragraphs alone.

    ``cluster`` is the id of the document with the cluster's first paragraph; ``spans``: the cluster reaches over
    several documents.
    """
    members = _members(docs, similarity, False).withColumn("gone", F.lit(False))
    return _judged(members).select("doc_id", "pos", "n_words", "cluster", "spans", "removed")


def shared_passages(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, pos, size, n_words, cluster, spans, removed, in_spans, in_removed) of every line and paragraph in a
    cluster of several.

    A unit covers ``size`` paragraphs from ``pos``. ``in_spans``, ``in_removed``: it is a part of a line of which that
    is true already. ``cluster`` is null unless it spans several documents.
    """
    members = _members(docs, similarity, True)
    lines = materialize(_judged(members.filter("up = 0").withColumn("gone", F.lit(False))), "paragraph-lines")
    of_line = lines.select(F.col("uid").alias("line"), F.col("spans").alias("in_spans"), F.col("removed").alias("in_removed"))
    parts = (members.filter("up <> 0").withColumn("line", F.when(F.col("up") > 0, F.col("uid") - F.col("up")))
             .join(of_line, "line", "left").na.fill(False, ["in_spans", "in_removed"]).withColumn("gone", F.col("in_removed")))
    no, span = F.lit(False), F.when(F.col("spans"), F.col("cluster"))
    parts = (_judged(materialize(parts, "paragraph-parts")).withColumn("piece", F.col("uid") - F.col("again").cast("long"))
             .groupBy("piece").agg(*[F.first(c).alias(c) for c in ("doc_id", "pos", "size", "n_words", "in_spans", "in_removed")],
                                   F.min(span).alias("cluster"), F.bool_or("spans").alias("spans"), F.bool_or("removed").alias("removed")))
    return parts.drop("piece").unionByName(lines.select("doc_id", "pos", "size", "n_words", span.alias("cluster"), "spans", "removed",
                                                        no.alias("in_spans"), no.alias("in_removed")))


def without_paragraphs(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """The documents with the removed paragraphs cut out of their texts (ids must be unique)."""
    removed = shared.filter("removed")
    if "size" in shared.columns:
        removed = removed.withColumn("pos", F.explode(F.sequence("pos", F.expr("pos + size - 1"))))
    gone = removed.groupBy("doc_id").agg(F.collect_set("pos").alias("gone")).withColumnRenamed("doc_id", "_id")
    joined = docs.select("doc_id", text_bytes().alias("text")).join(gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for s, e in ([paragraph_spans(text)[p] for p in sorted(gone, reverse=True)] if gone else []):
                    text = text[:s] + text[e:]
                out.append(text.decode("utf-8", "replace"))
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return joined.mapInArrow(run, "doc_id long, text string")


def op8_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    shared, gone = F.expr("spans and not in_spans"), F.expr("removed and not in_removed")
    found = shared_passages(docs).groupBy("doc_id").agg(
        F.sum(F.when(shared, F.col("size")).otherwise(0)).alias("n_shared"), F.sum(F.when(gone, F.col("size")).otherwise(0)).alias("n_removed"),
        F.sum(F.when(gone, F.col("n_words")).otherwise(0)).alias("removed_words"),
        F.sort_array(F.collect_set("cluster")).alias("clusters")).withColumnRenamed("doc_id", "_id")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return ids.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", zero("n_shared"), zero("n_removed"), zero("removed_words"),
        F.coalesce("clusters", F.array().cast("array<bigint>")).alias("clusters"))
