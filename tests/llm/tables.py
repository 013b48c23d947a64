"""Small tables with the awkward cases: nulls, blanks, repeats, near-copies, long and non-ASCII texts, clashing names."""

import random

from pyspark.sql import types as T

# Names that the operators use for columns of their own.
CLASHING = ("size", "shard", "fp", "row", "key", "n", "slot", "stratum", "cutoffs", "bucket", "target", "root", "taken", "_n")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), *[T.StructField(c, T.StringType()) for c in CLASHING]])


def sentence(rng, n):
    return " ".join(rng.choice(SYLLABLES) + rng.choice(SYLLABLES) + rng.choice(SYLLABLES) for _ in range(n)).capitalize() + "."


SYLLABLES = ("an", "be", "tion", "er", "th", "on", "é", "in", "re", "st", "wo", "li")


def awkward_rows():
    rng = random.Random(3)
    prose = [" ".join(sentence(rng, rng.randrange(4, 20)) for _ in range(rng.randrange(5, 12))) for _ in range(16)]
    near = prose[0].split()
    near[7] = "changed"
    texts = [
        (0, prose[0]), (1, " ".join(near)), (2, prose[0]), (3, None), (4, ""), (5, " \t\n\r "), (6, "one"), (7, "ONE two\x0bthree"),
        (8, "a b  c\n\nd é日本"), (None, prose[1]), (None, prose[1]), (9, prose[2]), (9, prose[2]), (9, prose[3]),
        (-5, "\n".join([prose[4].split(".")[0]] * 9)), (10, "### $$$ | " * 40), (11, "word " * 3000), (12, " ".join(prose) + "\n" + " ".join(prose)),
        (2**40, prose[5] + "\n" + prose[6]), (13, prose[7] + " " + prose[6]), (14, prose[8]), (15, prose[9].upper()), (16, prose[9]),
        (17, "x" * 5000), (18, "\x00\x01 nul"), *[(20 + i, prose[10 + i % 6] + f" Tail {i}.") for i in range(12)],
    ]
    sources = ("b", "a", None, "é", "", "Z")
    return [(i, t, ("en", "fr", None)[n % 3], sources[n % 6], *["clash"] * len(CLASHING)) for n, (i, t) in enumerate(texts)]


def write(spark, rows, schema, folder, name="documents", files=3):
    path = f"{folder}/{name}.parquet"
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.read.parquet(path)
