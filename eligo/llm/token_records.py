"""Token ids as length-delimited binary records with checksums and a separate offset index.

A record is framed as: length (8 bytes), masked checksum of the length (4), payload, masked checksum of the
payload (4), all little-endian. The checksum is CRC-32C; the mask rotates it right by 15 bits and adds
0xA282EAD8, so that data holding checksums can be checksummed again. The payload is the document id (8
bytes), a flag byte (bit 0: the id is null; bit 1: ids take 4 bytes, else 2) and the token ids. A vocabulary of
up to 65,536 ids is stored in 2 bytes an id.

Writing: the documents are dealt out by ranges of ``doc_id`` and sorted within each (ties by text, so that an
id shared by many rows can be split); each task encodes and frames its range as a stream into one shard file.
Every attempt writes a file of its own name, and the index, which Spark commits as Parquet, names the files of
the attempts that count, so a lost executor or a repeated task leaves the records whole. The index has each
record's file, offset and length, for reads in any order.

Encoding gives the ids that the tokenizers library gives for the whole text. It is cut where a byte-level
tokenizer always cuts (before a single space or line feed between two characters that are not white space),
and the ids of the pieces are remembered by the worker process, up to a fixed number of pieces.

Defined cases: a null text is empty (the end id alone); null ids come first; repeated rows are separate
records; an empty table writes an empty index and reads back no rows.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eligo.llm.common import documents, text_bytes, work_path, worker_cache

END_ID = 0
PIECES = 500_000   # pieces remembered by a worker process
MASK_DELTA = 0xA282EAD8
HEAD = "<qB"
HEAD_SIZE = struct.calcsize(HEAD)
INDEX = "shard int, file string, doc_id long, offset long, length long, n_tokens long"


# ---- checksums -------------------------------------------------------------------------------------------

def _crc_tables() -> list[np.ndarray]:
    """tables[k][lane]: what a checksum register with one byte set in ``lane`` becomes after 4 * 2**k zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = (byte >> 1) ^ (np.uint32(0x82F63B78) * (byte & 1))  # CRC-32C, reflected

    def four_zero_bytes(x: np.ndarray) -> np.ndarray:
        for _ in range(4):
            x = (x >> 8) ^ byte[x & 0xFF]
        return x

    table = np.stack([four_zero_bytes(np.arange(256, dtype=np.uint32) << (8 * lane)) for lane in range(4)])
    tables = [table]
    for _ in range(40):
        tables.append(_shift(tables[-1], tables[-1]))
    return tables


def _shift(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0][x & 0xFF] ^ table[1][(x >> 8) & 0xFF] ^ table[2][(x >> 16) & 0xFF] ^ table[3][x >> 24]


def crc32c(messages: list[bytes]) -> np.ndarray:
    """CRC-32C of each message (of 4 bytes at least), many at a time.

    Messages of like length are laid out as rows of 32-bit words, zeros in front (they leave a zero register
    as it is), and neighbouring words' checksums are merged until one is left per row.
    """
    tables = worker_cache().setdefault("crc32c", None) or _crc_tables()
    worker_cache()["crc32c"] = tables
    lengths = np.fromiter(map(len, messages), np.int64, len(messages))
    classes = np.ceil(np.log2(np.maximum(1, -(-lengths // 4)))).astype(int)
    out = np.zeros(len(messages), np.uint32)
    for c in np.unique(classes):
        which = np.flatnonzero(classes == c)
        width = 4 << int(c)
        rows = np.frombuffer(b"".join(messages[i].rjust(width, b"\0") for i in which), np.uint8).reshape(len(which), width).copy()
        first = width - lengths[which]
        for k in range(4):
            rows[np.arange(len(which)), first + k] ^= 0xFF
        x = _shift(tables[0], rows.view("<u4").astype(np.uint32))
        k = 0
        while x.shape[1] > 1:
            x = _shift(tables[k], x[:, 0::2]) ^ x[:, 1::2]
            k += 1
        out[which] = x[:, 0] ^ np.uint32(0xFFFFFFFF)
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return (((crc >> 15) | (crc << 17)) + np.uint32(MASK_DELTA)).astype(np.uint32)


# ---- encoding --------------------------------------------------------------------------------------------

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
# One word of Latin letters with what may come before and behind it; the tokenizer splits it into these groups.
_WORD = re.compile("(\n?)( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


def _byte_letters() -> str:
    """The letter that byte-level vocabularies use for each byte: itself if printable, else the next from 256 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = (b for b in range(256) if b not in same)
    letters = {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(other)}
    return "".join(letters[b] for b in range(256))


class Encoder:
    """Token ids of texts, as little-endian bytes."""

    def __init__(self, path: str, limit: int = PIECES):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        pre = kind.get("pre_tokenizer") or {}
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.byte_level = (not kind.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                           and not pre.get("add_prefix_space"))
        self.model, self.letters, self.limit = self.tokenizer.model, _byte_letters(), limit
        self.groups: dict[str, bytes] = {}
        outer = self

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                found = outer.piece(piece if piece[0] == "\n" else " " + piece)
                if len(self) < outer.limit:
                    self[piece] = found
                return found

        self.pieces = Pieces()

    def group(self, text: str) -> bytes:
        """Ids of a run that the tokenizer never splits before its merges."""
        found = self.groups.get(text)
        if found is None:
            seen = text.encode().decode("latin-1").translate(self.letters)
            found = np.array([t.id for t in self.model.tokenize(seen)], self.kind).tobytes()
            if len(self.groups) < self.limit:
                self.groups[text] = found
        return found

    def piece(self, text: str) -> bytes:
        simple = _WORD.fullmatch(text)
        if simple:
            return b"".join(self.group(g) for g in simple.groups() if g)
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.byte_level:
            return self.whole(text)
        if " ".join(text.split()) == text.replace("\n", " "):  # single spaces and line feeds between words alone
            first, *rest = text.replace("\n", " \n").split(" ")
            return self.piece(first) + b"".join(map(self.pieces.__getitem__, rest))
        return b"".join(self.piece(p) for p in _CUT.split(text))


def encoder(path: str) -> Encoder:
    found = worker_cache().get(("encoder", path))
    if found is None:
        found = worker_cache()[("encoder", path)] = Encoder(path)
    return found


# ---- files -----------------------------------------------------------------------------------------------

def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Frame a sorted partition into one file; rows of the index."""
    enc = encoder(tokenizer)
    end = np.array([END_ID], enc.kind).tobytes()
    flag = 2 if enc.width == 4 else 0
    shard = TaskContext.get().partitionId()
    files, base = pafs.FileSystem.from_uri(folder)
    name, out, offset = f"shard-{shard:06d}-{uuid.uuid4().hex}.rec", None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0)
        codes = [enc.encode(t.as_py().decode("utf-8", "replace")) + end for t in batch.column(1)]
        payloads = [struct.pack(HEAD, i.as_py() or 0, flag | (not i.is_valid)) + c for i, c in zip(ids, codes)]
        sizes = [struct.pack("<Q", len(p)) for p in payloads]
        size_crc, data_crc = masked(crc32c(sizes)).astype("<u4"), masked(crc32c(payloads)).astype("<u4")
        if out is None:
            files.create_dir(base, recursive=True)
            out = files.open_output_stream(f"{base}/{name}")
        out.write(b"".join(x for s, a, p, b in zip(sizes, size_crc, payloads, data_crc) for x in (s, a.tobytes(), p, b.tobytes())))
        lengths = np.fromiter(map(len, payloads), np.int64, len(payloads))
        offsets = offset + np.concatenate(([0], np.cumsum(lengths + 16)[:-1]))
        offset = int(offsets[-1] + lengths[-1] + 16)
        n = batch.num_rows
        yield pa.record_batch(
            [pa.array([shard] * n, pa.int32()), pa.array([name] * n), ids, pa.array(offsets), pa.array(lengths),
             pa.array((lengths - HEAD_SIZE) // enc.width)], ["shard", "file", "doc_id", "offset", "length", "n_tokens"])
    if out is not None:
        out.close()


def write_records(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Write ``docs`` (doc_id, text) as records under ``path``; the index, as committed."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    tie = F.xxhash64("text")
    ranged = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    ranged.mapInArrow(lambda it: _write_shard(it, f"{path}/records", tokenizer), INDEX).write.parquet(f"{path}/index")
    return read_index(docs.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


class CorruptRecord(ValueError):
    pass


def _checked(frames: list[tuple[bytes, bytes, bytes, bytes]]) -> list[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of framed records whose checksums hold."""
    sizes, payloads = [f[0] for f in frames], [f[2] for f in frames]
    for data, stored in ((sizes, [f[1] for f in frames]), (payloads, [f[3] for f in frames])):
        if (masked(crc32c(data)) != np.frombuffer(b"".join(stored), "<u4")).any():
            raise CorruptRecord("a record's checksum does not match")
    out = []
    for p in payloads:
        doc, flag = struct.unpack_from(HEAD, p)
        out.append((None if flag & 1 else doc, np.frombuffer(p, "<u4" if flag & 2 else "<u2", offset=HEAD_SIZE)))
    return out


def _frames(stream, chunk: int = 8 << 20) -> Iterator[list[tuple[bytes, bytes, bytes, bytes]]]:
    """The records of a file in order, some at a time; a large length is checked before so much is read."""
    held, at, found, size = b"", 0, [], 0
    while True:
        if len(held) - at < 12:
            held, at = held[at:] + stream.read(chunk), 0
            if not held:
                break
            if len(held) < 12:
                raise CorruptRecord("the file ends within a record")
        length_bytes, length_crc = held[at:at + 8], held[at + 8:at + 12]
        need = 16 + int.from_bytes(length_bytes, "little")
        if need > chunk and masked(crc32c([length_bytes]))[0] != int.from_bytes(length_crc, "little"):
            raise CorruptRecord("a record's length does not match its checksum")
        if len(held) - at < need:
            held, at = held[at:] + stream.read(max(chunk, need)), 0
            if len(held) < need:
                raise CorruptRecord("the file ends within a record")
        found.append((length_bytes, length_crc, held[at + 12:at + need - 4], held[at + need - 4:at + need]))
        at, size = at + need, size + need
        if size > chunk:
            yield found
            found, size = [], 0
    if found:
        yield found


def _read_files(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, base = pafs.FileSystem.from_uri(folder)
    for batch in batches:
        for row in batch.to_pylist():
            start = row["start"]
            with files.open_input_stream(f"{base}/{row['file']}") as stream:
                for frames in _frames(stream):
                    records = _checked(frames)
                    n = np.array([len(ids) for _, ids in records], np.int64)
                    crc = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in records]
                    yield pa.record_batch(
                        [pa.array([d for d, _ in records], pa.int64()), pa.array(start + np.cumsum(n) - n), pa.array(n),
                         pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    start += int(n.sum())


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read every file in order and check it: doc_id, start, n_tokens, ids_crc32 of each record."""
    index = read_index(spark, path)
    shards = index.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    shards = shards.select("shard", "file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("start"))
    n = max(1, shards.count())
    return shards.repartitionByRange(n, "shard").mapInArrow(
        lambda it: _read_files(it, f"{path}/records"), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_shuffled(spark: SparkSession, path: str, seed: int, partitions: int | None = None) -> DataFrame:
    """All records (doc_id, ids) in an order set by ``seed``, fetched one by one through the index."""
    key = F.xxhash64(F.lit(seed), F.col("file"), F.col("offset"))
    rows = read_index(spark, path).select("file", "offset", "length", key.alias("key"))
    rows = (rows.repartitionByRange(partitions, "key") if partitions else rows.repartitionByRange("key")).sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(f"{path}/records")
        for batch in batches:
            frames = []
            for row in batch.to_pylist():
                with files.open_input_file(f"{base}/{row['file']}") as f:
                    raw = f.read_at(row["length"] + 16, row["offset"])
                frames.append((raw[:8], raw[8:12], raw[12:-4], raw[-4:]))
            if frames:
                got = _checked(frames)
                yield pa.record_batch([pa.array([d for d, _ in got], pa.int64()), pa.array([i.astype(np.int64) for _, i in got],
                                                                                       pa.list_(pa.int64()))], ["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<long>")


def op1_query(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = str(public_tokenizers.path("byte_bpe_50k.json"))
    path = work_path(spark, "token-records")
    write_records(documents(spark, sf_dir), path, tokenizer)
    return read_digests(spark, path)
