"""Token counts by greedy longest match in linear time.

The vocabulary's pieces make a trie. Where a word cannot be followed further from a node, the greedy match
gives out some pieces and goes on from another node: both depend on the node alone and are worked out once, the
node as its failure link and the pieces as a mere count. Matching a word then reads each byte once, adds up the
counts on the failure links it takes, and never builds a piece or goes back in the text.

Words are lower-cased (A-Z) and matched with a space in front, as the byte-level vocabulary writes the start of
a word. A word with a byte that no piece covers counts as one unknown token. The automaton is as large as
the vocabulary, a fixed file, and goes to every task; counts of words seen are remembered by the worker
process up to a fixed number.

Defined cases: a null or blank text has no words and no tokens; repeated rows are counted each; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.llm.common import documents, text_bytes, worker_cache

REMEMBERED = 1_000_000


def read_vocabulary(path: str) -> list[bytes]:
    """The pieces of a file with one base64 piece and its rank per line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


def build_automaton(pieces: Iterable[bytes]) -> tuple[dict[int, int], list[int], list[int]]:
    """(moves, links, popped). moves: node * 256 + byte -> node, node 0 is the root; link -1: no way on."""
    moves: dict[int, int] = {}
    whole = [False]
    for piece in pieces:
        node = 0
        for byte in piece:
            at = node << 8 | byte
            if at not in moves:
                moves[at] = len(whole)
                whole.append(False)
            node = moves[at]
        if piece:
            whole[node] = True
    children: list[list[tuple[int, int]]] = [[] for _ in whole]
    for at, node in moves.items():
        children[at >> 8].append((at & 255, node))
    links, popped = [-1] * len(whole), [0] * len(whole)
    todo = deque([0])
    while todo:
        parent = todo.popleft()
        for byte, node in children[parent]:
            if whole[node]:
                links[node], popped[node] = 0, 1
            else:
                at, given = links[parent], popped[parent]
                while at >= 0 and (at << 8 | byte) not in moves:
                    given += popped[at]
                    at = links[at]
                if at >= 0:
                    links[node], popped[node] = moves[at << 8 | byte], given
            todo.append(node)
    return moves, links, popped


def count_pieces(word: bytes, automaton: tuple) -> int:
    """Pieces of the greedy longest match of ``word``; 1 (unknown) if it has none, 0 if empty."""
    moves, links, popped = automaton
    node, total = 0, 0
    for byte in word:
        while (to := moves.get(node << 8 | byte)) is None:
            if links[node] < 0:
                return 1
            total += popped[node]
            node = links[node]
        node = to
    while node:
        if links[node] < 0:
            return 1
        total += popped[node]
        node = links[node]
    return total


class Counts(dict):
    """Pieces of each word, remembered up to a limit."""

    def __init__(self, automaton: tuple, limit: int = REMEMBERED):
        super().__init__()
        self.automaton, self.limit = automaton, limit

    def __missing__(self, word: bytes) -> int:
        n = count_pieces(b" " + word, self.automaton)
        if len(self) < self.limit:
            self[word] = n
        return n


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every document under the pieces of the file ``vocabulary``."""
    shipped = docs.sparkSession.sparkContext.broadcast(build_automaton(read_vocabulary(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = ("pieces", vocabulary)
        held = worker_cache().get(name)
        if held is None:
            held = worker_cache()[name] = Counts(shipped.value)
        for batch in batches:
            words = [t.as_py().lower().split() for t in batch.column(1)]
            totals = [sum(map(held.__getitem__, w)) for w in words]
            yield pa.record_batch([batch.column(0), pa.array(np.fromiter(map(len, words), np.int64, len(words))),
                                   pa.array(totals, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op6_query(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers
        vocabulary = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts(documents(spark, sf_dir), vocabulary)
