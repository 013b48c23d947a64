"""Line dedup: lines that many documents share stay in one document only.

Texts are exploded into lines; a line's key is the line with ASCII white space (0x20, 0x09-0x0D) stripped at both
ends and A-Z lower-cased. Keys of at least ``min_chars`` code points are hashed to 128 bits, the distinct documents
of each hash are counted, and the lines of a hash found in at least ``min_docs`` documents are dropped, except in
the document with the largest id among them. Documents are put together again from the positions that stay.

Only hashes, ids and positions are exchanged to find the lines; the texts are moved once, to meet the positions that
go. Counting groups by (hash, document) before it groups by hash, and both steps combine within the map tasks, so a
line that every document holds loads no task. The counted hashes and the dropped positions are written to the
shared folder, so that adaptive execution can split a hot hash or a hot row in the joins that follow.

Defined cases: a document is a value of ``doc_id``; rows that share it count as one document and keep or lose a line
alike. Rows without an id are together one document, which is less than every other. A null text is one empty line,
as is an empty one. A document that loses all its lines gets an empty text. Repeats of a line within a document count
once and go or stay together. Very long texts are split like any other: the largest value held is one row's lines. An
empty table gives no rows. The input's own columns are carried as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eligo.llm.common import documents, fresh, materialize

MIN_CHARS = 20
MIN_DOCS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two words that tell rows with another id or another text apart."""
    parts = [doc_id.isNull(), doc_id, F.coalesce(text.cast("string"), F.lit(""))]
    return [F.xxhash64(*parts).alias("r1"), F.xxhash64(F.lit(1), *parts).alias("r2")]


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(r1, r2, doc_id, pos, k1, k2) of every line whose key has ``min_chars`` code points or more."""
    rows = docs.select(*_row_key(F.col("doc_id"), F.col("text")), "doc_id", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = rows.select("r1", "r2", "doc_id", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        "r1", "r2", "doc_id", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, n_docs, keeper): hashes of lines that at least ``min_docs`` documents hold, and the one that keeps them."""
    held = _long_lines(docs, min_chars).groupBy("k1", "k2", "doc_id").agg(F.lit(1).alias("one"))
    return (held.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
            .filter(F.col("n_docs") >= min_docs))


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(r1, r2, dropped): the positions of the lines that each row loses, for rows that lose any."""
    repeated = materialize(repeated_lines(docs, min_chars, min_docs), "repeated-lines")
    lost = (_long_lines(docs, min_chars).join(repeated, ["k1", "k2"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))))
    return lost.groupBy("r1", "r2").agg(F.collect_set("pos").alias("dropped"))


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the lines that stay as ``text``; the counts are added under names that ``docs`` does not use."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    dropped = materialize(dropped_positions(docs, min_chars, min_docs), "dropped-lines")
    keyed = docs.select(row, *_row_key(F.col("doc_id"), F.col("text")))
    found = keyed.join(dropped, ["r1", "r2"], "left").select("row", "dropped", split_lines(F.col("row.text")).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    text = F.when(F.col("dropped").isNull(), F.coalesce(F.col("row.text").cast("string"), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda p: F.get("lines", p)), "\n"))
    return found.select(
        *[text.alias("text") if c.lower() == "text" else F.col(f"row.`{c}`") for c in docs.columns],
        F.size("lines").cast("long").alias(fresh(docs, n_lines)),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias(fresh(docs, n_dropped)))


def op13_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT row_no, doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
marked AS (
  SELECT k.row_no, k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_no, doc_id
"""
