"""Prediction by partial matching over lower-cased (A-Z) bytes: code length of each document under a corpus model.

The model is a trie of byte contexts up to ``order`` bytes long, held as the counts of what followed each
context in the training documents. A byte is coded in the longest context that occurs in training: a byte seen
there n times, among T observations of D distinct bytes, has probability n / (T + D), and D / (T + D) is the
escape (method C) to the context one byte shorter, where the bytes that the longer context had seen are
excluded. After the empty context comes an even choice among the bytes never seen. A text is preceded by
``order`` pad bytes (0xFE) and followed by one end byte (0xFF), neither of which occurs in UTF-8, so the
probabilities of all texts sum to at most one. The score is pretrained: the model does not change while it scores.

What a context excludes is what its one-byte-longer child saw, and those sets only grow towards shorter
contexts. So per context it is enough to keep T, D and, of its suffix context, the observations (X) and distinct
bytes (Y) left after excluding its own bytes; both come from one join of the count table with itself.

Scale: counts are summed per task, then by Spark over all training documents; the model grows with the corpus, is
never cut and never leaves Spark's tables. The code length of a byte depends only on its longest context and the byte,
so what the training documents hold is rated in that table, and what only held-out documents hold is rated once per
distinct pair, by a join per context length on those still open. The texts are cut into chunks of about ``CHUNK`` bytes;
every chunk asks for its distinct pairs. Questions and rated pairs meet by a remainder of the pair, about
``max_entries`` rated pairs in one place at most, whatever their contexts are, and the answers go back to the chunk, which sums
them per document. A worker holds one such place or one chunk at a time. The word counts of the base score are joined by
word; only the ``frequent`` most common words, a fixed number, are shipped to every task.

Defined cases: a null text is empty and scored by its end byte; a null ``doc_id`` counts as the empty string
for the fold, which puts it in training; repeated rows are scored and counted each; without training rows all
bytes are equally likely; a text longer than a chunk is a chunk of its own and is handled in windows; an empty table
gives no rows.
"""

from __future__ import annotations

import gc
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eligo.llm.common import documents, materialize, text_bytes

ORDER = 5
MAX_ENTRIES = 1_000_000   # rated pairs in one place
CHUNK = 8 << 20           # bytes of text that ask together
ASKED = 64 << 20          # bytes of text whose questions go to one place on average
PRIME, FACTOR, SHIFT = 15_485_863, 73_856_093, 10   # spread pairs over places; products stay far below 64 bits
FREQUENT = 200_000        # words whose counts go to every task
PAD, END = 0xFE, 0xFF
WINDOW = 1 << 18          # positions handled at a time
MERGE = 600_000           # counts that a task gathers before it adds them up
FLUSH = 1_500_000         # distinct ones held by a task before it passes them on


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _positions(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, document of each key): the context and byte at each position, packed into one integer.

    Texts go through in windows of bounded size, long ones in several.
    """
    pad, end = bytes([PAD]) * order, bytes([END])
    data = np.frombuffer(b"".join(pad + t + end for t in texts), np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(lengths + order)[:-1])) + order  # first coded byte of each text
    at = np.concatenate(([0], np.cumsum(lengths)))                            # the same among coded bytes
    for lo in range(0, int(at[-1]), WINDOW):
        hi = min(lo + WINDOW, int(at[-1]))
        first, last = np.searchsorted(at, [lo, hi - 1], side="right") - 1
        owner = np.repeat(np.arange(first, last + 1), np.diff(np.clip(at[first:last + 2], lo, hi)))
        place = np.arange(lo, hi) - at[owner] + starts[owner]
        b, e = int(place[0]) - order, int(place[-1]) + 1
        piece = data[b:e].astype(np.int64)
        keys = np.zeros(len(piece) - order, np.int64)
        for i in range(order + 1):
            keys = (keys << 8) | piece[i:len(piece) - order + i]
        yield keys[place - b - order], owner


def _count_grams(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0  # entries not merged yet

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*held))
        sort = np.argsort(keys)
        keys = keys[sort]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.add.reduceat(n[sort], first)

    for batch in batches:
        for keys, _ in _positions([t.as_py().lower() for t in batch.column(0)], order):
            held.append(np.unique(keys, return_counts=True))
            waiting += len(held[-1][0])
            if waiting > MERGE:
                held, waiting = [merged()], 0
                if len(held[0][0]) > FLUSH:
                    yield pa.record_batch([pa.array(x) for x in held[0]], ["key", "n"])
                    held = []
    if held:
        yield pa.record_batch([pa.array(x) for x in merged()], ["key", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column(0):
            held.update(text.as_py().lower().split())
            if len(held) > FLUSH // 2:
                yield out()
                held.clear()
    if held:
        yield out()


class Lookup:
    """Open addressing over int64 keys (non-negative); finds many keys at once, fast."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self.bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = [np.zeros(1 << self.bits, np.float32) for _ in values]
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            s = slot[left]
            free = np.flatnonzero(self.keys[s] < 0)
            taken, which = np.unique(s[free], return_index=True)
            put = free[which]
            self.keys[taken] = keys[left[put]]
            for mine, v in zip(self.values, values):
                mine[taken] = v[left[put]]
            left = np.delete(left, put)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where it is missing."""
        slot = self._slot(np.ascontiguousarray(keys))
        there = self.keys[slot]
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        slot[there < 0] = -1
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[open_]]
            missing = there < 0
            go_on = ~missing & (there != keys[open_])
            slot[open_[missing]] = -1
            open_ = open_[go_on]
        return slot


class Model:
    """Count tables of the trie and of the words, in the shared folder."""

    def __init__(self, order: int, grams: DataFrame, contexts: DataFrame, words: DataFrame,
                 tokens: int, types: int, distinct: int):
        self.order, self.grams, self.contexts, self.words = order, grams, contexts, words
        self.tokens, self.types, self.distinct = tokens, types, distinct


def train(training: DataFrame, order: int = ORDER) -> tuple[Model, int]:
    """Count all of ``training`` (a column ``text`` of bytes); the model and the number of documents."""
    texts = training.select("text")
    top = materialize(texts.mapInArrow(lambda it: _count_grams(it, order), "key long, n long")
                      .groupBy("key").agg(F.sum("n").alias("n")), "ppm-top")
    levels = [top.withColumn("level", F.lit(order))]
    for j in range(order - 1, -1, -1):
        levels.append(levels[-1].groupBy(F.col("key").bitwiseAND(F.lit((1 << 8 * (j + 1)) - 1)).alias("key"))
                      .agg(F.sum("n").alias("n")).withColumn("level", F.lit(j)))
    counts = levels[0]
    for level in levels[1:]:
        counts = counts.unionByName(level)
    counts = materialize(counts, "ppm-counts")
    shorter = F.col("key").bitwiseAND(F.expr("shiftleft(1L, 8 * level) - 1"))
    up = counts.select((F.col("level") + 1).alias("level"), F.col("key").alias("short"), F.col("n").alias("short_n"))
    contexts = (counts.withColumn("short", shorter).join(up, ["level", "short"], "left")
                .groupBy("level", F.shiftright("key", 8).alias("key"))
                .agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("d"), F.sum("short_n").alias("taken")))
    suffix = F.when(F.col("level") > 0, F.col("key").bitwiseAND(F.expr("shiftleft(1L, 8 * (level - 1)) - 1")))
    contexts = materialize(contexts.withColumn("short", suffix), "ppm-contexts")
    up = contexts.select((F.col("level") + 1).alias("level"), F.col("key").alias("short"), F.col("t").alias("st"), F.col("d").alias("sd"))
    full = contexts.join(up, ["level", "short"], "left")
    x, y = F.col("st") - F.col("taken"), F.col("sd") - F.col("d")
    log = lambda c: F.coalesce(F.log10(c), F.lit(0.0)).cast("float")  # noqa: E731  nothing left: the escape is certain
    rated = materialize(full.select(
        "level", "key", log(F.col("t") + F.col("d")).alias("seen"), log(F.col("d") / (F.col("t") + F.col("d"))).alias("escape"),
        log(F.nullif(x + y, F.lit(0))).alias("rest"), log(y / F.nullif(x + y, F.lit(0))).alias("rest_escape")), "ppm-rates")
    of = rated.filter(F.col("level") == order).select(F.col("key").alias("ctx"), "seen")
    n = F.log10(F.col("n").cast("double"))
    high = (counts.filter(F.col("level") == order).withColumn("ctx", F.shiftright("key", 8)).join(of, "ctx")
            .select("level", "key", (n - F.col("seen")).cast("float").alias("lp")))
    low = counts.filter(F.col("level") < order).select("level", "key", n.cast("float").alias("lp"))
    grams = materialize(high.unionByName(low), "ppm-grams")
    words = materialize(texts.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "ppm-words")
    total, types = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    docs = counts.filter((F.col("level") == 0) & (F.col("key") == END)).agg(F.sum("n")).first()[0] or 0
    distinct = counts.filter(F.col("level") == 0).count()
    return Model(order, grams, rated, words, (total or 0) + docs, types + (docs > 0), distinct), docs


def backed_off(model: Model, keys: DataFrame) -> DataFrame:
    """(key, lp) of bytes that their longest context has not seen in training: one join per context length.

    Tables of context lengths 0 and 1 (65,792 entries at most) and the contexts of length 2 (65,536) may be broadcast.
    """
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    open_ = keys.select("key", *[F.lit(0.0).alias(c) for c in ("out", "rest", "rest_escape")], F.lit(False).alias("started"))
    found = []
    for j in range(model.order, -1, -1):
        contexts = model.contexts.filter(F.col("level") == j).select(
            F.col("key").alias("ctx"), "seen", "escape", F.col("rest").alias("left"), F.col("rest_escape").alias("left_escape"))
        grams = model.grams.filter(F.col("level") == j).select(F.col("key").alias("own"), "lp")
        own = F.col("key").bitwiseAND(F.lit((1 << 8 * (j + 1)) - 1))
        rows = open_.withColumn("own", own).withColumn("ctx", F.shiftright(own, 8)).join(F.broadcast(contexts) if j < 3 else contexts, "ctx", "left")
        if j < model.order:
            rows = rows.join(F.broadcast(grams) if j < 2 else grams, "own", "left")
        else:
            rows = rows.withColumn("lp", F.lit(None).cast("float"))
        known = F.col("seen").isNotNull()
        step = F.when(F.col("started"), F.col("rest_escape")).otherwise(zero("escape"))
        code = F.col("lp") - F.when(F.col("started"), F.col("rest")).otherwise(F.col("seen"))
        done = F.col("lp").isNotNull() & known
        rows = materialize(rows.select("key", (F.col("out") + F.when(done, code).otherwise(step)).alias("out"), zero("left").alias("rest"),
                                       zero("left_escape").alias("rest_escape"), (F.col("started") | known).alias("started"), done.alias("done")), "ppm-backed-off")
        found.append(rows.filter("done").select("key", F.col("out").alias("lp")))
        open_ = rows.filter("not done").drop("done")
    found.append(open_.select("key", (F.col("out") - float(np.log10(max(1, 256 - model.distinct)))).alias("lp")))
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    return all_found.withColumn("lp", F.col("lp").cast("float"))


CHUNKED = "doc_id long, held_out boolean, text binary, chunk long"


def _number_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their chunk: consecutive rows of about ``CHUNK`` bytes together."""
    chunk, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        numbers = []
        for text in batch.column(2):
            length = len(text.as_buffer())
            if size and size + length > CHUNK:
                chunk, size = chunk + 1, 0
            size += length
            numbers.append(chunk)
        yield pa.record_batch([*batch.columns, pa.array(numbers, pa.int64())], ["doc_id", "held_out", "text", "chunk"])


def place_of(keys: np.ndarray, places: int) -> np.ndarray:
    return (keys % PRIME * FACTOR >> SHIFT) % places


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; sorting is several times faster here than the hashing that ``np.unique`` does."""
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))]


def pack(keys: np.ndarray) -> bytes:
    """Ascending keys as compressed differences, which are small numbers mostly."""
    return struct.pack("<q", len(keys)) + pa.compress(np.diff(keys, prepend=0).astype("<i8").tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<q", packed)
    return np.cumsum(np.frombuffer(pa.decompress(packed[8:], 8 * n, codec="zstd"), "<i8"))


def _ask(batches: Iterator[pa.RecordBatch], order: int, places: int) -> Iterator[pa.RecordBatch]:
    """(place, chunk, keys): the distinct pairs of a chunk, by the place where their rates are."""
    for batch in batches:
        chunks = batch.column(1).to_numpy()
        begins = np.flatnonzero(np.diff(chunks, prepend=-1))
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(chunks)]):
            held, waiting = [], 0
            for keys, _ in _positions([t.as_py().lower() for t in batch.column(0).slice(begin, end - begin)], order):
                held.append(_distinct(keys))
                waiting += len(held[-1])
                if waiting > MERGE:
                    held, waiting = [_distinct(np.concatenate(held))], 0
            keys = _distinct(np.concatenate(held))
            place = place_of(keys, places)
            sort = np.argsort(place, kind="stable")
            keys, place = keys[sort], place[sort]
            cuts = np.flatnonzero(np.diff(place, prepend=-1))
            asked = [pack(keys[i:j]) for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])]
            yield pa.record_batch([pa.array(place[cuts]), pa.array([int(chunks[begin])] * len(cuts), pa.int64()), pa.array(asked, pa.binary())],
                                  ["place", "chunk", "keys"])


ANSWER = pa.schema([("chunk", pa.int64()), ("keys", pa.binary()), ("lp", pa.binary())])


def _answer(rated: pa.Table, asked: pa.Table) -> pa.Table:
    """The rates of the pairs that each chunk asks for."""
    keys, lp = rated.column("key").to_numpy(), rated.column("lp").to_numpy()
    order = np.argsort(keys)
    keys, lp = keys[order], lp[order].astype("<f4")
    found = [lp[np.searchsorted(keys, unpack(q.as_py()))].tobytes() for q in asked.column("keys")]
    return pa.table([asked.column("chunk"), asked.column("keys"), pa.array(found, pa.binary())], schema=ANSWER)


def _sum_up(docs: pa.Table, answers: pa.Table, order: int) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk with their score."""
    keys = np.concatenate([np.zeros(0, np.int64), *[unpack(k.as_py()) for k in answers.column("keys")]])
    lp = np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(v.as_buffer(), "<f4") for v in answers.column("lp")]])
    keys, once = np.unique(keys, return_index=True)  # a chunk read in two parts has asked for some pairs twice
    table = Lookup(keys, lp[once])
    for batch in docs.to_batches(max_chunksize=500):
        total = np.zeros(batch.num_rows)
        for keys, owner in _positions([t.as_py().lower() for t in batch.column("text")], order):
            total += np.bincount(owner, table.values[0][table.find(keys)], batch.num_rows)
        yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), batch.column("text"), pa.array(total)],
                              ["doc_id", "held_out", "text", "score"])


def rated_pairs(model: Model, asked: DataFrame, order: int) -> DataFrame:
    """(key, lp) of every context and byte of the training documents and of ``asked`` (a column ``text`` of bytes)."""
    known = model.grams.filter(F.col("level") == order).select("key", "lp")
    wanted = asked.select("text").mapInArrow(lambda it: _count_grams(it, order), "key long, n long").select("key").distinct()
    return known.unionByName(backed_off(model, materialize(wanted.join(known.select("key"), "key", "left_anti"), "ppm-unseen")))


def _tokens(batches: Iterator[pa.RecordBatch], frequent) -> Iterator[pa.RecordBatch]:
    """Per document: tokens, those among the frequent words with their logarithms, and the other words."""
    log = frequent.value.get
    for batch in batches:
        n, known, logs, rare, times, offsets = [], [], [], [], [], [0]
        for text in batch.column(2):
            words = text.as_py().lower().split()
            found = list(map(log, words))
            hits = [x for x in found if x is not None]
            others = Counter(w for w, x in zip(words, found) if x is None) if len(hits) < len(words) else {}
            n.append(len(words) + 1)
            known.append(len(hits))
            logs.append(float(np.sum(hits)) if hits else 0.0)
            rare.extend(others)
            times.extend(others.values())
            offsets.append(len(rare))
        pairs = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int64())], ["word", "n"])
        yield pa.record_batch([batch.column(0), batch.column(1), batch.column(3), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                               pa.array(logs, pa.float64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)],
                              ["doc_id", "held_out", "score", "n_tokens", "known", "logs", "rare"])


def _release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps, which it does once nothing on the driver refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def score(docs: DataFrame, order: int = ORDER, max_entries: int = MAX_ENTRIES, frequent: int = FREQUENT) -> DataFrame:
    """Train on the documents outside the held-out fold and score all of them (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes().alias("text"))
    rows = materialize(rows.mapInArrow(_number_chunks, CHUNKED), "ppm-chunks", "zstd")
    model, ends = train(rows.filter(~F.col("held_out")), order)

    _release(spark)
    rated = materialize(rated_pairs(model, rows.filter("held_out"), order), "ppm-rated")
    _release(spark)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    places = max(1, -(-rated.count() // max_entries), -(-size // ASKED))  # as many as the rates or the questions need
    placed = rated.withColumn("place", F.shiftright(F.col("key") % PRIME * FACTOR, SHIFT) % places)
    asked = rows.select("text", "chunk").mapInArrow(lambda it: _ask(it, order, places), "place long, chunk long, keys binary")
    answers = placed.groupBy("place").cogroup(asked.groupBy("place")).applyInArrow(_answer, "chunk long, keys binary, lp binary")

    common = model.words.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    logs = np.log10(common.column("n").to_numpy() + 0.5).tolist() if common.num_rows else []
    table = spark.sparkContext.broadcast(dict(zip((bytes(w) for w in common.column("word").to_pylist()), logs)))

    def finish(chunk: pa.Table, found: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_tokens(_sum_up(chunk, found, order), table))

    # The row number tells documents apart from here on; it is made once, with the rows it is stored with.
    tokens = materialize(rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, held_out boolean, score double, n_tokens long, known long, logs double, "
        "rare array<struct<word:binary,n:long>>").withColumn("row", F.monotonically_increasing_id()), "ppm-tokens")
    rare = (tokens.select("row", F.inline("rare")).withColumnRenamed("n", "times")
            .join(model.words, "word", "left")
            .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_logs"),
                                F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("rare_known")))
    norm = float(np.log10(model.tokens + 0.5 * (model.types + 1)))
    end_log = float(np.log10(ends + 0.5))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (tokens.drop("rare").join(rare, "row", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("known") + zero(F.col("rare_known")) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
                    F.lit(model.tokens).cast("long").alias("train_tokens"),
                    (F.col("logs") + zero(F.col("rare_logs")) + end_log - F.col("n_tokens") * norm).alias("base_score"), "score"))


def op4_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
