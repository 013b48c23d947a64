"""Alignment of two tokenizers' tokens over the same texts.

Tokenizer A (byte-level BPE, a tokenizers file) reads a space and the text; tokenizer B (a sentencepiece model, which
adds that space itself) reads the text. Both write a text as tokens with bytes; where a token of A and one of B end at
the same byte, the two are linked and the text is cut. Groups are what lies between two cuts.

Merging is done for many documents at once: a chunk of documents is cut into lanes (a document's start, and, in long
documents, places where both tokenizers are found to end), each lane has a pointer into A's and one into B's tokens, and
one step moves all lanes' pointers: the one whose token ends first, or both, which emits a link and a cut. Lanes that
have come to their end are taken out of the state. Memory is bounded by the chunk (``CHUNK`` bytes of text, or one
document if that is longer).

Corpus-wide counts of linked id pairs: the links of every document are written once as indices into the table of all
pairs that can be linked, counted with a vector per task, and summed by Spark. Linked tokens end at the same byte, so
one's bytes are a suffix of the other's: the vocabularies alone bound that table (about half a million pairs here,
however large the corpus), which is why its counts may go through the driver and be broadcast. A popular pair is a
number in each task's vector and loads no task.

A's tokens are made by the faster byte-pair library over the same vocabulary; texts that it refuses (white space runs
of some hundred thousand characters) are encoded by the tokenizers library itself, with the same ids.

Defined cases: null and empty texts, and texts whose joined bytes of A or B differ from a space and the text (B writes
U+2581 as a space), have no tokens, hence zeros and no groups. Strings of special tokens inside texts are plain text.
Repeated rows, null ids and rows that share an id are separate documents, and each counts. An empty table gives no rows.
Other columns of the input are not read, so that their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.llm.common import documents, text_bytes, work_path, worker_cache
from eligo.llm.token_records import _byte_letters

CHUNK = 4 << 20    # bytes of text aligned at a time
LANE = 512         # tokens of A after which a lane is cut, where both tokenizers end
TRIES = 32         # ends of A that are tried for such a place


class Tokenizers:
    """Both tokenizers, their tokens' bytes, and all pairs of ids that can be linked."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN
        with open(path_a, encoding="utf-8") as f:
            kind = json.load(f)
        back = {letter: byte for byte, letter in enumerate(_byte_letters())}
        special = {t["content"] for t in kind.get("added_tokens", ())}
        ranks = {bytes(back[c] for c in token): i for token, i in kind["model"]["vocab"].items() if token not in special}
        merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in kind["model"]["merges"]]
        order = [kind["model"]["vocab"][m] for m in merged]
        self.path_a, self._slow = path_a, None
        # Ids stand for ranks only where later merges have larger ids.
        self._fast = (tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
                      if all(x < y for x, y in zip(order, order[1:])) else None)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.n_b = self.b.get_piece_size()
        self.bytes_a = [b""] * (1 + max(kind["model"]["vocab"].values()))
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.n_b)]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int32)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int32)
        self.pairs = self._possible_pairs()

    def _possible_pairs(self) -> np.ndarray:
        """Sorted codes (id of A * size of B + id of B) of the pairs of which one is a suffix of the other."""
        with_a: dict[bytes, list[int]] = {}
        with_b: dict[bytes, list[int]] = {}
        for found, tokens in ((with_a, self.bytes_a), (with_b, self.bytes_b)):
            for i, token in enumerate(tokens):
                if token:
                    found.setdefault(token, []).append(i)
        codes = {a * self.n_b + b for token, ids in with_a.items() for k in range(len(token))
                 for b in with_b.get(token[k:], ()) for a in ids}
        codes |= {a * self.n_b + b for token, ids in with_b.items() for k in range(len(token))
                  for a in with_a.get(token[k:], ()) for b in ids}
        return np.array(sorted(codes), np.int64)

    def encode_a(self, text: str) -> np.ndarray:
        if self._fast is not None:
            try:
                return self._fast.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int32)
            except ValueError:
                pass
        if self._slow is None:
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_file(self.path_a)
            self._slow.encode_special_tokens = True
        return np.array(self._slow.encode(" " + text, add_special_tokens=False).ids, np.int32)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and of B; none where the text cannot be told from them."""
        none = np.zeros(0, np.int32)
        if not text:
            return none, none
        want = (" " + text).encode()
        a, b = self.encode_a(text), self.b.encode([text], num_threads=1)[0]
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return none, none
        return a, np.array(b, np.int32)


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    name = ("alignment", path_a, path_b)
    found = worker_cache().get(name)
    if found is None:
        found = worker_cache()[name] = Tokenizers(path_a, path_b)
    return found


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in A and in B of all linked tokens, in order.

    ``ends_a`` and ``ends_b`` ascend over the whole chunk and share their last value; ``starts_a`` and ``starts_b`` are
    the lanes' first tokens: what lies before the same byte on both sides.
    """
    i, j = starts_a.astype(np.int64), starts_b.astype(np.int64)
    stop = np.append(i[1:], len(ends_a))
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    while i.size:
        a, b = ends_a[i], ends_b[j]
        move_a, move_b = a <= b, b <= a
        both = move_a & move_b
        cut_a[i[both]] = True
        cut_b[j[both]] = True
        i += move_a
        j += move_b
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    return np.flatnonzero(cut_a), np.flatnonzero(cut_b)


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Lanes' first tokens: the documents' own, and places in long documents where both tokenizers are found to end."""
    wanted = np.arange(lane, len(ends_a), lane)
    more_a, more_b = [first_a], [first_b]
    for k in range(TRIES):
        at = wanted + k
        inside = at < len(ends_a) - 1
        wanted, at = wanted[inside], at[inside]
        if not len(at):
            break
        other = np.searchsorted(ends_b, ends_a[at])
        hit = ends_b[other] == ends_a[at]
        more_a.append(at[hit] + 1)
        more_b.append(other[hit] + 1)
        wanted = wanted[~hit]
    starts_a, starts_b = np.concatenate(more_a), np.concatenate(more_b)
    starts_a, once = np.unique(starts_a, return_index=True)
    return starts_a, starts_b[once]


class Aligned:
    """A chunk of documents, its tokens in one row after another, and its cuts."""

    def __init__(self, texts: list[str], both: Tokenizers):
        none = np.zeros(0, np.int32)
        codes = [both.encode(t) for t in texts]
        self.n_a = np.array([len(a) for a, _ in codes], np.int64)
        self.n_b = np.array([len(b) for _, b in codes], np.int64)
        self.a = np.concatenate([none, *[a for a, _ in codes]])
        self.b = np.concatenate([none, *[b for _, b in codes]])
        self.ends_a, self.ends_b = np.cumsum(both.len_a[self.a]), np.cumsum(both.len_b[self.b])
        first_a, first_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        some = self.n_a > 0
        self.cut_a, self.cut_b = lockstep(self.ends_a, self.ends_b, *lanes(self.ends_a, self.ends_b, first_a[some], first_b[some]))
        self.last_a = np.cumsum(self.n_a)
        # cuts up to the end of each document
        self.cuts = np.searchsorted(self.cut_a, self.last_a)
        self.n_groups = np.diff(self.cuts, prepend=0)
        self.pairs = np.searchsorted(both.pairs, self.a[self.cut_a].astype(np.int64) * both.n_b + self.b[self.cut_b]).astype(np.int32)

    def group_texts(self, digits: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        is_cut_a, is_cut_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        is_cut_a[self.cut_a] = True
        is_cut_b[self.cut_b] = True
        group_a, group_b = np.cumsum(is_cut_a) - is_cut_a, np.cumsum(is_cut_b) - is_cut_b
        place_a = np.arange(len(self.a)) + np.concatenate(([0], self.cut_b + 1))[group_a]
        place_b = np.arange(len(self.b)) + (self.cut_a + 1)[group_b]
        cells = np.zeros((len(self.a) + len(self.b), digits.shape[1] + 1), np.uint8)
        cells[place_a, :-1] = digits[self.a]
        cells[place_b, :-1] = digits[self.b]
        cells[place_a, -1] = np.where(is_cut_a, ord("|"), ord(","))
        cells[place_b, -1] = np.where(is_cut_b, ord(";"), ord(","))
        used = cells != 0
        stops = np.concatenate(([0], np.cumsum(used.sum(1))))[np.cumsum(self.n_a + self.n_b)].tolist()
        flat = cells[used].tobytes()
        return [flat[start:stop - 1] if stop > start else b"" for start, stop in zip([0, *stops], stops)]


def digit_table(n: int) -> np.ndarray:
    """The decimal digits of 0 to n - 1 as bytes, zeros behind."""
    width = len(str(n - 1))
    return np.frombuffer(b"".join(str(i).encode().ljust(width, b"\0") for i in range(n)), np.uint8).reshape(n, width)


def _chunks(batch: pa.RecordBatch, limit: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts (second column) of a batch, up to ``limit`` bytes together, with the first one's place."""
    start, held, size = 0, [], 0
    for k, value in enumerate(batch.column(1)):
        raw = value.as_py()
        if held and size + len(raw) > limit:
            yield start, held
            start, held, size = k, [], 0
        held.append(raw.decode("utf-8", "replace"))
        size += len(raw)
    if held:
        yield start, held


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))


def aligned_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, group, start, end, a_ids, b_ids): every group of every document, its bytes in the text with its space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        for batch in batches:
            for start, texts in _chunks(batch):
                x = Aligned(texts, both)
                doc = np.repeat(np.arange(len(texts)), x.n_groups)
                ends = x.ends_a[x.cut_a]
                begins = np.concatenate(([0], ends[:-1]))[:len(ends)]
                base = np.concatenate(([0], x.ends_a))[x.last_a - x.n_a][doc]
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], cut + 1)), pa.int32()), pa.array(ids))
                         for cut, ids in ((x.cut_a, x.a), (x.cut_b, x.b))]
                number = np.arange(len(doc)) - (x.cuts - x.n_groups)[doc]
                yield pa.record_batch([batch.column(0).slice(start, len(texts)).take(pa.array(doc)), pa.array(number), pa.array(begins - base),
                                       pa.array(ends - base), *lists], ["doc_id", "group", "start", "end", "a_ids", "b_ids"])

    return _rows(docs).mapInArrow(run, "doc_id long, group long, start long, end long, a_ids array<int>, b_ids array<int>")


def _aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: its counts, the digest of its groups, and its links as indices of possible pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        digits = digit_table(max(len(both.bytes_a), both.n_b))
        for batch in batches:
            for start, texts in _chunks(batch):
                x = Aligned(texts, both)
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in x.group_texts(digits)]
                raw = x.pairs.astype("<i4").tobytes()
                links = [raw[4 * (stop - n):4 * stop] for stop, n in zip(x.cuts.tolist(), x.n_groups.tolist())]
                yield pa.record_batch([batch.column(0).slice(start, len(texts)), pa.array(x.n_a), pa.array(x.n_b), pa.array(x.n_groups),
                                       pa.array(digests), pa.array(links, pa.binary())],
                                      ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return _rows(docs).mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary")


def _pair_counts(links: DataFrame, size: int) -> DataFrame:
    """(pair, n): how many links hold each possible pair, for those that any holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                np.add.at(total, np.frombuffer(value.as_buffer(), "<i4"), 1)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(total[found])], ["pair", "n"])

    return links.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def document_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    spark = docs.sparkSession
    both = tokenizers(path_a, path_b)
    path = work_path(spark, "alignment")
    # Small numbers in four bytes: a stronger compression than the default is worth its time here.
    _aligned_documents(docs, path_a, path_b).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    found = _pair_counts(stored, len(both.pairs)).toArrow()
    counts = np.zeros(len(both.pairs), np.int64)
    counts[found["pair"].to_numpy()] = found["n"].to_numpy()
    highest = np.zeros(both.n_b, np.int64)
    np.maximum.at(highest, both.pairs % both.n_b, counts)
    shipped = spark.sparkContext.broadcast((counts, counts == highest[both.pairs % both.n_b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = shipped.value
        for batch in batches:
            links = [np.frombuffer(v.as_buffer(), "<i4") for v in batch.column("links")]
            yield pa.record_batch(
                [*[batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")], pa.array([len(x) for x in links], pa.int64()),
                 pa.array([int(best[x].sum()) for x in links], pa.int64()), pa.array([int(count[x].sum()) for x in links], pa.int64()),
                 batch.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return stored.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op12_query(spark: SparkSession, sf_dir: str, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    if path_a is None or path_b is None:
        import public_tokenizers
        path_a = path_a or str(public_tokenizers.path("byte_bpe_50k.json"))
        path_b = path_b or str(public_tokenizers.path("piece_bpe_32k.model"))
    return document_links(documents(spark, sf_dir), path_a, path_b)
