"""Phrase collocations: frequent phrases of two to four words, scored by how seldom their parts stand apart.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and tabs into words.
All counts are per language and cover all documents. A suffix is a position in a piece with the words from there on,
four at most.

1. Words are counted, chunk by chunk within the map tasks and then by Spark; this also gives the number of words.
2. Suffixes are routed by a hash of language and first two words into bins of about ``BIN_WORDS`` suffixes. The bins'
   number grows with the words counted. All suffixes of one pair are in one bin.
3. In a bin, pointers to the suffixes are sorted by multikey three-way quicksort: by a pivot word at the present depth
   into smaller, equal and larger, the equal ones going on to the next word, to four words. The size of an equal
   partition is the count of its phrase; a partition with fewer than ``least`` pointers holds no frequent phrase at this
   depth or a deeper one and is abandoned.
4. Bins of more than four times the usual load hold a very common pair. They are found beforehand from every 64th suffix
   (this decides about the way only; counts are of all suffixes on both ways), are at most one in four, and are
   not sent to one task: there the same sort, without abandoning, counts phrases in each chunk of the map tasks, and Spark
   sums these counts by phrase.

Scores, cuts and containment are DataFrame steps over the frequent phrases, with decimals where products may pass 64
bits. The ranking limits each task's rows of a language before they are exchanged.

Defined cases: a null text is empty, a null language ``und``; blank texts have no words; documents of any length are
read in slices that overlap by three words, so that a task holds one chunk of words and one text; repeated rows count as
often as they occur; ties in score go to the more frequent phrase, then to the first in byte order; an empty table gives
no rows. Only ``lang`` and ``text`` are read, so that other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eligo.llm.common import documents, materialize, text_bytes

LEAST = 30
DEPTH = 4
CHUNK_WORDS = 1_000_000
BIN_WORDS = 1 << 19
SLICE = 4 << 20      # bytes of a text split at a time
EVERY = 64           # suffixes per one that is looked at to find heavy bins
MARK = b"."          # stands for every separator of pieces; never part of a word
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + MARK * 9)


# ---- suffixes --------------------------------------------------------------------------------------------

class Vocabulary(dict):
    """Words of a chunk, numbered as they come; 0 is the mark between pieces."""

    def __init__(self):
        super().__init__({MARK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _slices(text: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """Words and marks of a text, some at a time."""
    folded = text.translate(_FOLD).replace(MARK, b" " + MARK + b" ")
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + size)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def chunks(batches: Iterator[pa.RecordBatch], chunk_words: int) -> Iterator[tuple[list[bytes], dict[str, np.ndarray]]]:
    """Chunks of the texts: their words, and per language the suffixes as rows of word numbers, 0 where a piece ends."""
    vocabulary, pending, held = Vocabulary(), {}, 0

    def flush(open_lang: str | None) -> tuple[list[bytes], dict[str, np.ndarray]]:
        nonlocal vocabulary, pending, held
        words, suffixes, kept = list(vocabulary), {}, None
        for lang, parts in pending.items():
            ids = np.concatenate(parts)
            end = len(ids)
            if lang == open_lang:  # within a text: its last words wait for those behind them
                end = max(0, end - (DEPTH - 1))
                kept = [words[i] for i in ids[end:].tolist()]
            rows = np.zeros((len(ids), DEPTH), np.int32)
            rows[:, 0] = ids
            for d in range(1, DEPTH):
                rows[:-d, d] = np.where(rows[:-d, d - 1] > 0, ids[d:], 0)
            suffixes[lang] = rows[:end][ids[:end] > 0]
        vocabulary, pending, held = Vocabulary(), {}, 0
        if kept:
            pending[open_lang] = [np.fromiter(map(vocabulary.__getitem__, kept), np.int32, len(kept))]
        return words, suffixes

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang = lang.as_py()
            for tokens in _slices(text.as_py()):
                pending.setdefault(lang, []).append(np.fromiter(map(vocabulary.__getitem__, tokens), np.int32, len(tokens)))
                held += len(tokens)
                if held >= chunk_words:
                    yield flush(lang)
            pending.setdefault(lang, []).append(np.zeros(DEPTH - 1, np.int32))  # the text ends
    if pending:
        yield flush(None)


def pair_hashes(lang: str, rows: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """An unsigned 32-bit hash of language and first two words."""
    h = crc[rows[:, 0]] * np.uint64(0x9E3779B97F4A7C15) ^ (crc[rows[:, 1]] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(zlib.crc32(lang.encode())))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(29))) >> np.uint64(32)


def _word_crc(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


# ---- sorting ---------------------------------------------------------------------------------------------

def phrase_counts(rows: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of two to four words found at least ``least`` times as first words of ``rows``, and their counts.

    Multikey three-way quicksort of pointers to the rows, to the last word's depth. A phrase is given as a row of word
    numbers, 0 behind its last word.
    """
    columns = [np.ascontiguousarray(rows[:, d]) for d in range(DEPTH)]
    found: list[tuple[int, int, int]] = []   # a pointer to an instance, words, count
    stack = [(np.arange(len(rows), dtype=np.int32), 0)] if len(rows) >= least else []
    while stack:
        at, depth = stack.pop()
        keys = columns[depth][at]
        n = len(keys)
        pivot = sorted((keys[0], keys[n >> 1], keys[-1]))[1]
        equal = keys == pivot
        same = at if equal.all() else at[equal]
        if len(same) < n:
            smaller = at[keys < pivot]
            if len(smaller) >= least:
                stack.append((smaller, depth))
            if n - len(same) - len(smaller) >= least:
                stack.append((at[keys > pivot], depth))
        if pivot and len(same) >= least:
            if depth:
                found.append((int(same[0]), depth + 1, len(same)))
            if depth + 1 < DEPTH:
                stack.append((same, depth + 1))
    first, size, count = np.array(found, np.int64).reshape(-1, 3).T
    phrases = rows[first] * (np.arange(DEPTH) < size[:, None])
    return phrases, count


def _phrase_batch(lang: str, words: list[bytes], phrases: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    texts = [b" ".join([words[i] for i in row if i]) for row in phrases.tolist()]
    return pa.record_batch([pa.array([lang] * len(texts), pa.string()), pa.array(texts, pa.binary()),
                            pa.array((phrases > 0).sum(1).astype(np.int32)), pa.array(counts, pa.int64())], ["lang", "phrase", "k", "f"])


PHRASES = "lang string, phrase binary, k int, f long"


# ---- Spark -----------------------------------------------------------------------------------------------

def _word_counts(rows: DataFrame, chunk_words: int) -> DataFrame:
    """(lang, word, hash, n): counts of words, and of the hashes of every 64th suffix (word null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, suffixes in chunks(batches, chunk_words):
            crc = _word_crc(words)
            for lang, x in suffixes.items():
                n = np.bincount(x[:, 0], minlength=len(words))
                used = np.flatnonzero(n)
                some, sampled = np.unique(pair_hashes(lang, x[x[:, 1] > 0][::EVERY], crc), return_counts=True)
                yield pa.record_batch(
                    [pa.array([lang] * (len(used) + len(some)), pa.string()), pa.array([words[i] for i in used] + [None] * len(some), pa.binary()),
                     pa.array(np.concatenate((np.zeros(len(used)), some)).astype(np.int64)),
                     pa.array(np.concatenate((n[used], sampled)).astype(np.int64))], ["lang", "word", "hash", "n"])

    return rows.mapInArrow(run, "lang string, word binary, hash long, n long").groupBy("lang", "word", "hash").agg(F.sum("n").alias("n"))


def _binned(rows: DataFrame, bins: int, heavy: np.ndarray, chunk_words: int) -> DataFrame:
    """(bin, lang, words, ids): for each chunk and bin that is not heavy, the suffixes and the words they use."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, suffixes in chunks(batches, chunk_words):
            crc = _word_crc(words)
            out: list[tuple] = []
            for lang, x in suffixes.items():
                x = x[x[:, 1] > 0]
                bin_of = (pair_hashes(lang, x, crc) % np.uint64(bins)).astype(np.int32)
                x, bin_of = x[~(go := np.isin(bin_of, heavy))], bin_of[~go]
                order = np.argsort(bin_of, kind="stable")
                x, bin_of = x[order], bin_of[order]
                begins = np.flatnonzero(np.diff(bin_of, prepend=-1))
                for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(x)]):
                    used, ids = np.unique(x[begin:end], return_inverse=True)
                    if used[0]:
                        used, ids = np.concatenate(([0], used)), ids + 1
                    out.append((int(bin_of[begin]), lang, b"\n".join([words[i] for i in used[1:].tolist()]),
                                ids.astype("<u2" if len(used) <= 1 << 16 else "<u4").tobytes()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.string(), pa.binary(), pa.binary()))]
                                  if out else [pa.array([], t) for t in (pa.int32(), pa.string(), pa.binary(), pa.binary())],
                                  ["bin", "lang", "words", "ids"])

    return rows.mapInArrow(run, "bin int, lang string, words binary, ids binary")


def _sort_bin(least: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("k", pa.int32()), ("f", pa.int64())])
        out = []
        names = table.column("lang").to_pylist()
        for lang in set(names):
            vocabulary, parts = Vocabulary(), []
            for k, name in enumerate(names):
                if name == lang:
                    own = table.column("words")[k].as_py().split(b"\n")
                    place = np.fromiter(map(vocabulary.__getitem__, own), np.int32, len(own))
                    raw = table.column("ids")[k].as_buffer()
                    parts.append(np.concatenate(([0], place)).astype(np.int32)[np.frombuffer(raw, "<u2" if len(own) < 1 << 16 else "<u4")])
            out.append(_phrase_batch(lang, list(vocabulary), *phrase_counts(np.concatenate(parts).reshape(-1, DEPTH), least)))
        return pa.Table.from_batches(out, schema)

    return run


def _heavy_counts(rows: DataFrame, bins: int, heavy: np.ndarray, chunk_words: int) -> DataFrame:
    """(lang, phrase, k, f) of all phrases in the heavy bins, summed over the chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, suffixes in chunks(batches, chunk_words):
            crc = _word_crc(words)
            for lang, x in suffixes.items():
                x = x[x[:, 1] > 0]
                x = x[np.isin((pair_hashes(lang, x, crc) % np.uint64(bins)).astype(np.int32), heavy)]
                if len(x):
                    yield _phrase_batch(lang, words, *phrase_counts(x, 1))

    return rows.mapInArrow(run, PHRASES).groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, chunk_words: int = CHUNK_WORDS, bin_words: int = BIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of one to four words found ``least`` times or more, and (lang, n): all words."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_bytes().alias("text"))
    words = materialize(_word_counts(rows, chunk_words), "word-counts")
    totals = words.filter("word is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    n = totals.agg(F.sum("n")).first()[0] or 0
    bins = max(1, -(-n // bin_words))
    # At most one bin in four has over four times the mean load.
    heavy = np.array([r.bin for r in words.filter("word is null").groupBy((F.col("hash") % bins).cast("int").alias("bin"))
                      .agg(F.sum("n").alias("n")).filter(F.col("n") * EVERY > 4 * bin_words).select("bin").toLocalIterator()], np.int32)
    phrases = (_binned(rows, bins, heavy, chunk_words).groupBy("bin").applyInArrow(_sort_bin(least), PHRASES)
               .unionByName(words.filter("word is not null").select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), F.col("n").alias("f"))))
    if len(heavy):
        phrases = phrases.unionByName(_heavy_counts(rows, bins, heavy, chunk_words))
    phrases = phrases.filter(F.col("f") >= least).withColumn("phrase", F.col("phrase").cast("string"))
    return materialize(phrases, "frequent-phrases"), totals


def collocations(docs: DataFrame, least: int = LEAST, covered: int = 80, **sizes: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): candidates with their lowest-scoring cut.

    Phrases whose words lie within a longer one that has ``covered`` percent of their count or more are left out.
    """
    counts, totals = frequent_phrases(docs, least, **sizes)
    found = counts.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = found.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("c"))
    cut = cut.select("lang", "phrase", "a", "c", F.array_join(F.slice("w", F.lit(1), F.col("c")), " ").alias("left"),
                     F.array_join(F.slice("w", F.col("c") + 1, F.col("k")), " ").alias("right"))
    cut = cut.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cut.select("lang", "phrase", "a", F.struct(score.alias("score"), "c", "l", "r").alias("best"), F.lit(None).cast("long").alias("inside"))
    # every shorter phrase of two words or more within a candidate, with the candidate's count
    within = found.filter("k > 2").select(
        "lang", "k", "a", "w", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")).select(
        "lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at")).select(
        "lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), F.lit(None).cast("long").alias("a"),
        F.lit(None).cast(scored.schema["best"].dataType).alias("best"), F.col("a").alias("inside"))
    whole = scored.unionByName(within).groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min("best").alias("best"), F.max("inside").alias("inside"))
    big = lambda c: F.col(c).cast("decimal(20,0)")
    kept = whole.filter(F.col("inside").isNull() | (big("inside") * 100 < big("a") * covered))
    return kept.join(totals, "lang").select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def top_collocations(docs: DataFrame, top: int = 2000, least: int = LEAST, covered: int = 80, **sizes: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs, least, covered, **sizes).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_collocations(documents(spark, sf_dir))


ORACLE = r"""
WITH pieces AS (
  SELECT lang, row_no, unnest(p) AS piece, generate_subscripts(p, 1) AS piece_no
  FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row_no,
               regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]') AS p FROM documents)),
words AS (SELECT lang, row_no, piece_no, unnest(w) AS w, generate_subscripts(w, 1) AS pos
          FROM (SELECT lang, row_no, piece_no, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)),
led AS (SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
        FROM words WINDOW p AS (PARTITION BY row_no, piece_no ORDER BY pos)),
grams AS (SELECT lang, w1 AS phrase, 1 AS k FROM led
          UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM led WHERE w2 IS NOT NULL
          UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM led WHERE w3 IS NOT NULL
          UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM led WHERE w4 IS NOT NULL),
counts AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 30),
cuts AS (SELECT c.lang, c.phrase, c.a, c.w, x.f AS l, y.f AS r, j.j AS j,
                ((c.a::HUGEINT * 2000000) // (x.f::HUGEINT + y.f::HUGEINT))::BIGINT AS score
         FROM cand c JOIN (SELECT unnest([1, 2, 3]) AS j) j ON j.j < c.k
         JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, j.j), ' ')
         JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, j.j + 1, c.k), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (SELECT c.lang, array_to_string(list_slice(c.w, s.s, s.s + z.z - 1), ' ') AS phrase, max(c.a) AS f
           FROM cand c, (SELECT unnest([2, 3]) AS z) z, (SELECT unnest([1, 2, 3]) AS s) s
           WHERE z.z < c.k AND s.s + z.z - 1 <= c.k GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
         WHERE i.f IS NULL OR 100 * i.f::HUGEINT < 80 * b.a::HUGEINT),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
