import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F, types as T

from eligo.llm import lines
from tests.llm import tables

SHARED = ["the quick brown fox jumps over it", "  The QUICK brown fox jumps over IT\t", "a short line", "Ünïcode line of twenty cp", "x" * 19, "y" * 20]


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\x20\x09\x0a\x0b\x0c\x0d"))


def plain(rows):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = []
        for line in all_lines:
            who = holders.get(key(line), set())
            largest = max((w for w in who if w is not None), default=None)
            if len(who) < 3 or i == largest:
                kept.append(line)
        out.append((i, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(map(str, out))


def awkward():
    rng = random.Random(5)
    rows = [(r[0], r[1]) for r in tables.awkward_rows()]
    for i in range(60):
        rows.append((rng.choice([None, *range(100, 130)]), "\n".join(rng.choice(SHARED + [f"own line number {i} of a document", ""]) for _ in range(rng.randrange(1, 12)))))
    rows.append((500, "\n".join([SHARED[0]] * 40_000 + [f"line {n} of a very long document" for n in range(40_000)])))
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    rows = awkward()
    tables.write(spark, rows, schema, tmp_path)
    got = lines.op13_query(spark, str(tmp_path)).collect()
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256)) for r in got) == plain(rows)


def test_texts_and_clashing_columns(docs):
    clashing = docs.withColumn("n_lines", F.lit("mine")).withColumn("row", F.lit("mine"))
    got = lines.deduplicated(clashing, min_chars=5, min_docs=2)
    assert got.columns == [*clashing.columns, "_n_lines", "n_dropped"]
    rows = got.collect()
    assert len(rows) == clashing.count() and {r.n_lines for r in rows} == {"mine"}
    assert all(len(r.text.split("\n")) == r._n_lines - r.n_dropped or r.text == "" for r in rows)


def test_empty(no_docs):
    assert lines.deduplicated(no_docs).count() == 0
