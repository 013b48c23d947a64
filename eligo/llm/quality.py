"""Quality rules whose cutoffs are certified on labelled documents.

Each rule rejects a document whose value lies beyond a cutoff. For every stratum (language) and rule the
candidate cutoffs are tested from the most lenient to the strictest on the labelled good documents (quality 1)
that pass the base rules: a cutoff is certified if, were its true rate of false rejections above the
rule's allowance, so few rejected good documents would be seen with probability at most delta (exact binomial
tail, which is the Clopper-Pearson upper bound put as a test). Testing stops at the first cutoff that fails (a
fixed sequence needs no further correction). So, with probability 1 - delta over the labelled sample, no stratum
loses more than ``max_false_rejection`` of its good documents to all rules together. A stratum with too few labels
certifies nothing and keeps what passes the base rules.

Two ways of testing. Rule by rule, the allowed rate is divided by the number of rules, and delta by strata times
rules: some 1,500 good labels a stratum are needed. Jointly (``joint``), all rules step together, each along its own
list, and one sequence of such vectors is tested at the full rate: some 250 good labels suffice. A rule that fits a
stratum badly holds up the others in a joint sequence, so with ``joint`` each way gets half of delta, both promises
hold at once, and each stratum takes the way that has come more steps. The query and the pipeline test jointly.

Base rules: under 50 words, or over half of the words inside 3-word windows that occur again.

Defined cases: a null text has no words; a null language is a stratum of its own; several labels of one
document count as good only if all say so; labels without a document (or with null quality) are passed over;
without labels no cutoff is certified; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eligo.llm.common import documents, fresh, materialize, text_bytes

MAX_FALSE_REJECTION = 0.02  # of a stratum's good documents, over all rules
DELTA = 0.05                # chance that any stratum's promise fails

# Rule: (value, cutoffs from lenient to strict); the value rejects above the cutoff.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols per word": ("n_symbols / n_words", (2.0, 1.0, 0.5, 0.25, 0.1, 0.05)),
    "share of repeated lines": ("n_dup_lines / n_lines", (0.9, 0.7, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2)),
    "share of repeated words": ("n_repeat_words / n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15)),
    "long words": ("word_chars / n_words", (14.0, 12.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0)),
    "short words": ("-word_chars / n_words", (-2.0, -2.5, -3.0, -3.5, -4.0, -4.5, -5.0)),
}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])  # white space and continuation bytes


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur at least twice in the text."""
    grams = list(zip(*(words[i:] for i in range(width))))
    if len(set(grams)) == len(grams):
        return 0
    seen = Counter(grams)
    again = np.fromiter((seen[g] > 1 for g in grams), bool, len(grams))
    covered = np.zeros(len(words), bool)
    for i in range(width):
        covered[i:len(grams) + i] |= again
    return int(covered.sum())


def count_text(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(text.translate(None, _NOT_COUNTED)), len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines))


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """The documents and a struct column ``name`` of their counts."""
    kinds = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    arrow = pa.struct([(c, pa.int64()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [count_text(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            cols = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
            found = pa.StructArray.from_arrays([pa.array(c) for c in cols], fields=list(arrow))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*batch.schema.names[:-1], name])

    rows = docs.select(*[docs[c] for c in docs.columns], text_bytes().alias(name))
    return rows.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kinds)]))


def base_failed(c: str = "") -> Column:
    return (F.col(f"{c}n_words") < 50) | (F.col(f"{c}n_repeat_words") * 100 > F.col(f"{c}n_words") * 50)


def rule_value(rule: str, c: str = "") -> Column:
    over, under = RULES[rule][0].split(" / ")
    top = -F.col(c + over[1:]) if over[0] == "-" else F.col(c + over)
    return top / F.nullif(F.col(c + under), F.lit(0))


def binomial_tail(k: int, n: int, rate: float) -> float:
    """P(at most k of n) for independent events of probability ``rate``, summed from the largest term down."""
    if k >= n * rate:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate))
    total, i = term, k
    while i and term > total * 1e-17:
        term *= i / (n - i + 1) * (1 - rate) / rate
        total += term
        i -= 1
    return min(1.0, total)


def strictest_certified(rejected: list[int], n: int, rate: float, delta: float) -> int:
    """Index of the last cutoff certified in sequence, -1 for none."""
    chosen = -1
    for i, k in enumerate(rejected):
        if n == 0 or binomial_tail(int(k), int(n), rate) > delta:
            break
        chosen = i
    return chosen


def _held(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled good documents that pass the base rules."""
    good = (labels.groupBy("doc_id").agg(F.min("quality").alias("_q"), F.count_if(F.col("quality").isNull()).alias("_0"))
            .filter("_q = 1 and _0 = 0").select("doc_id"))
    return counted.filter(~base_failed()).join(good, "doc_id", "left_semi")


def certified_cutoffs(counted: DataFrame, labels: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION,
                      delta: float = DELTA, rules: dict | None = None) -> DataFrame:
    """One row per stratum with a certified cutoff: ``stratum`` and ``cutoffs``, a map from rule to cutoff.

    ``counted`` has doc_id, stratum and the counts. A certified stratum has at least log(1 / delta) / rate
    good labels (some 1,500 at the defaults), which bounds the rows by the labels.
    """
    rules = rules or RULES
    values = _held(counted, labels).select("stratum", F.explode(F.array(*[
        F.struct(F.lit(i).alias("rule"), rule_value(r).alias("value")) for i, r in enumerate(rules)])).alias("x"))
    widest = max(len(c) for _, c in rules.values())

    def beyond(place: int) -> Column:
        """Does the row's rule reject it at its cutoff number ``place``?"""
        out = F.lit(False)
        for i, (_, cuts) in enumerate(rules.values()):
            if place < len(cuts):
                out = F.when(F.col("x.rule") == i, F.col("x.value") > cuts[place]).otherwise(out)
        return out

    seen = materialize(values.groupBy("stratum", F.col("x.rule").alias("rule")).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.count_if(beyond(p)) for p in range(widest)]).alias("rejected")), "holdout")
    strata = max(1, seen.select("stratum").distinct().count())
    names, cuts = list(rules), [c for _, c in rules.values()]
    rate, level = max_false_rejection / len(rules), delta / (strata * len(rules))

    def certify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            best = [strictest_certified(list(r)[:len(cuts[i])], n, rate, level) for i, n, r in zip(f.rule, f.n, f.rejected)]
            out = pd.DataFrame({"stratum": f.stratum, "rule": [names[i] for i in f.rule],
                                "cutoff": [cuts[i][b] if b >= 0 else None for i, b in zip(f.rule, best)]})
            yield out[out.cutoff.notna()].astype({"cutoff": float})

    return (seen.mapInPandas(certify, "stratum string, rule string, cutoff double")
            .groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")))


def joint_cutoffs(counted: DataFrame, labels: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION,
                  delta: float = DELTA, rules: dict | None = None) -> DataFrame:
    """As ``certified_cutoffs``, with all rules stepped together, or rule by rule where that comes further.

    A certified stratum has at least log(2 / delta) / rate good labels (some 180 at the defaults with one stratum),
    which bounds the rows by the labels.
    """
    rules = rules or RULES
    names, cuts = list(rules), [c for _, c in rules.values()]
    widest = max(map(len, cuts))
    beyond = lambda i, p: F.coalesce(rule_value(names[i]) > cuts[i][min(p, len(cuts[i]) - 1)], F.lit(False))
    seen = materialize(_held(counted, labels).groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.count_if(reduce(or_, [beyond(i, p) for i in range(len(cuts))])) for p in range(widest)]).alias("together"),
        *[F.array(*[F.count_if(beyond(i, p)) for p in range(len(c))]).alias(f"rule{i}") for i, c in enumerate(cuts)]), "holdout")
    strata = max(1, seen.count())

    def certify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                p = strictest_certified(list(row.together), row.n, max_false_rejection, delta / (2 * strata))
                together = [min(p, len(c) - 1) for c in cuts]
                single = [strictest_certified(list(getattr(row, f"rule{i}")), row.n, max_false_rejection / len(cuts),
                                              delta / (2 * strata * len(cuts))) for i in range(len(cuts))]
                best = max(together, single, key=sum)
                out += [(row.stratum, names[i], float(cuts[i][b])) for i, b in enumerate(best) if b >= 0]
            yield pd.DataFrame(out, columns=["stratum", "rule", "cutoff"]).astype({"cutoff": float})

    return (seen.mapInPandas(certify, "stratum string, rule string, cutoff double")
            .groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")))


def verdict(rules: dict | None = None, c: str = "", cutoffs: str = "cutoffs") -> Column:
    """True unless a base rule or a certified cutoff rejects the row; ``cutoffs`` is null where none is certified."""
    out = ~base_failed(c)
    for r in rules or RULES:
        out = out & F.coalesce(rule_value(r, c) <= F.col(cutoffs)[r], F.lit(True))
    return out


def stratum(col: str = "lang") -> Column:
    return F.col(col).cast("string")


def judged(docs: DataFrame, labels: DataFrame, joint: bool = False) -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every document; the counts are made once."""
    counted = materialize(with_counts(docs.select("doc_id", stratum().alias("stratum"), "text"), "c")
                          .select("doc_id", "stratum", "c.*"), "quality-counts")
    cutoffs = (joint_cutoffs if joint else certified_cutoffs)(counted, labels)
    out = counted.join(F.broadcast(cutoffs), counted["stratum"].eqNullSafe(cutoffs["stratum"]), "left")  # bounded: see there
    return out.select("doc_id", *COUNTS, base_failed().alias("base_failed"), verdict().alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, joint: bool = False) -> DataFrame:
    """The documents that no rule rejects, with their columns.

    The cutoffs come from a first pass that keeps counts alone; the second pass counts again beside the full
    rows, so that no text is shuffled.
    """
    counted = materialize(with_counts(docs.select("doc_id", stratum().alias("stratum"), "text"), "c")
                          .select("doc_id", "stratum", "c.*"), "quality-counts")
    name, of, cuts = fresh(docs, "_counts"), fresh(docs, "_of"), fresh(docs, "_cutoffs")
    cutoffs = (joint_cutoffs if joint else certified_cutoffs)(counted, labels).select(F.col("stratum").alias(of), F.col("cutoffs").alias(cuts))
    out = with_counts(docs, name).join(F.broadcast(cutoffs), stratum().eqNullSafe(F.col(of)), "left")  # bounded: see there
    return out.filter(verdict(c=name + ".", cutoffs=cuts)).select(*docs.columns)


def op9_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), joint=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
