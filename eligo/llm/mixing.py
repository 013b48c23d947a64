"""Mixing sources to target weights, block by block.

Each source's words form one stream (documents in a fixed order), packed into blocks of a fixed length.
The output is a run of shards with a fixed number of block slots each. Every slot of a shard draws its
source with the target probabilities, so a shard's source counts are multinomial; draws beyond a source's
target go, slot by slot, to the sources that fell short, so that the totals meet the targets. The n-th slot
of a source reads the block at place n of a pseudorandom permutation of the source's block indexes, a new
one for each pass over the source, and the blocks come in by a join on (source, index). All steps are
DataFrame functions.

The permutation is a swap-or-not shuffle: each round maps x to (k - x) mod n or leaves it, as a hash of the
larger of the two says. It is defined for any n, needs no table and is its own inverse round by round.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share all words; a target
stops at three times its source's size, and the excess is shared by weight among the rest. With sources in
ascending order of (limit / weight) the limited ones are a prefix, found by running sums.

Defined cases: a null or blank text has size 0 and takes nothing; a null source is a source of its own;
repeated rows are separate documents; an empty table gives no rows. Results depend on the rows and the seed
alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eligo.llm.common import WORD, documents, fresh, materialize

WEIGHTS = (5, 2, 1)
LIMIT = 3          # times its size that a source may be taken
BLOCK = 256        # words a block
SLOTS = 8192       # block slots an output shard
SLOTS_PER_TASK = 1 << 15   # slots that one task makes, on average
GROUP = 1 << 10            # shards summed up as one in running totals
ROUNDS = 32        # of the permutation
BUCKETS = 1024     # parts of a source in which running sums are made
CELLS = 1024       # of the guide table from draws to sources
SEED = 7


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """One row per source: ``source_id`` (its rank), ``source_size``, ``target``."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("source_id") % len(weights))
    per = (per.withColumn("source_id", rank).withColumn("_w", weight.cast("double"))
           .withColumn("_cap", (F.col("source_size") * limit).cast("double")))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), "source_id")
    total = F.sum("source_size").over(everything).cast("double")
    capped_before = F.sum("_cap").over(fill) - F.col("_cap")
    open_weight = F.sum("_w").over(everything) - F.sum("_w").over(fill) + F.col("_w")
    per = (per.withColumn("_total", total)
           .withColumn("_full", (F.col("_total") - capped_before) * F.col("_w") > F.col("_cap") * open_weight))
    rest = F.col("_total") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0.0))
    level = rest / F.sum(F.when(~F.col("_full"), F.col("_w"))).over(everything)
    return per.select("source", "source_id", "source_size",
                      F.when(F.col("_full"), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("_w")))
                      .alias("target"))


def permuted(x: Column, n: Column, key: tuple, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """Place of ``x`` under the permutation of 0..n-1 named by ``key``."""
    order = F.array(*[F.lit(r) for r in (reversed(range(rounds)) if inverse else range(rounds))])

    def step(at, r):
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        swap = F.xxhash64(*key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(order, x, step)


def plan_sources(targets: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Blocks and block slots of each source.

    ``passes`` whole passes and ``last_slots`` slots of one more give ``floor(target)`` words; the last slot is
    cut to ``last_words``. Only the stream's last block may be short, so the words before a slot follow from
    whether that block comes earlier in the pass.
    """
    size, b = F.col("source_size"), F.lit(block)
    t = (targets.filter(size > 0)
         .withColumn("blocks", F.ceil(size / b))
         .withColumn("short", size - (F.col("blocks") - 1) * b)
         .withColumn("words", F.least(F.floor(F.col("target") + 1e-6), size * LIMIT))
         .withColumn("passes", F.expr("words div source_size"))
         .withColumn("left", F.col("words") - F.col("passes") * size))
    key = (F.lit(seed), F.col("source_id"), F.col("passes"))
    t = (t.withColumn("short_at", permuted(F.col("blocks") - 1, F.col("blocks"), key, inverse=True))
         .withColumn("_k", F.ceil(F.col("left") / b)))
    lost = b - F.col("short")
    last = F.when((F.col("short_at") < F.col("_k")) & (F.col("_k") * b - lost < F.col("left")), F.col("_k") + 1).otherwise(F.col("_k"))
    t = t.withColumn("last_slots", last)
    before = (F.col("last_slots") - 1) * b - F.when(F.col("short_at") < F.col("last_slots") - 1, lost).otherwise(0)
    return t.select("source_id", "blocks", "short", "passes", "last_slots",
                    F.when(F.col("last_slots") > 0, F.col("left") - before).otherwise(0).alias("last_words"),
                    (F.col("passes") * F.col("blocks") + F.col("last_slots")).alias("slots"))


def running_total(rows: DataFrame, value: str, out: str, order: list[str], within: list[str] | None = None, group: str = "shard") -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before, by ``order`` (``group`` first), within equal ``within``.

    In two levels: sums of ``GROUP`` consecutive numbers of ``group`` are run through first, one row each.
    """
    keys = within or []
    part = F.expr(f"{group} div {GROUP}")
    tall = rows.withColumn("_part", part)
    sums = tall.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_before", F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_sum")).drop("_sum")
    inner = Window.partitionBy(*keys, "_part").orderBy(*order)
    return (tall.withColumn("_own", F.sum(value).over(inner) - F.col(value)).join(sums, [*keys, "_part"])
            .withColumn(out, F.col("_before") + F.col("_own")).drop("_part", "_before", "_own"))


def draw_slots(plan: DataFrame, slots_per_shard: int = SLOTS, cells: int = CELLS, seed: int = SEED) -> DataFrame:
    """(shard, source_id, j): which of its slots each source has in which shard; j runs from 0 to slots - 1."""
    spark = plan.sparkSession
    total = plan.agg(F.sum("slots")).first()[0] or 0
    step = max(1, -(-total // cells))
    wanted = (plan.filter("slots > 0")
              .withColumn("hi", F.sum("slots").over(Window.orderBy("source_id")))
              .withColumn("lo", F.col("hi") - F.col("slots")))
    # Guide table: the sources whose share of [0, total) meets a cell; at most cells + sources rows.
    guide = wanted.select("source_id", "lo", "hi", F.explode(F.sequence(
        F.expr(f"lo div {step}"), F.expr(f"(hi - 1) div {step}"))).alias("cell"))
    draws = spark.range(total).select(
        F.expr(f"id div {slots_per_shard}").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(max(1, total))).alias("u"))
    draws = draws.withColumn("cell", F.expr(f"u div {step}"))
    drawn = (draws.join(guide, "cell").filter("u >= lo and u < hi")
             .groupBy("shard", "source_id").agg(F.count(F.lit(1)).alias("n")))
    drawn = materialize(
        running_total(drawn.join(wanted.select("source_id", "slots"), "source_id"), "n", "first", ["shard"], ["source_id"])
        .withColumn("kept", F.greatest(F.lit(0), F.least(F.col("n"), F.col("slots") - F.col("first")))), "mix-draws")
    # Few rows stand for all slots: they are dealt out before the slots are made of them.
    tasks = max(1, -(-total // SLOTS_PER_TASK))
    kept = drawn.filter("kept > 0").repartition(tasks, "shard", "source_id").select(
        "shard", "source_id", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("kept") - 1)).alias("j"))
    # Slots over a source's target, numbered through, go to the sources under theirs.
    spare = (running_total(drawn.filter("n > kept").withColumn("spare", F.col("n") - F.col("kept")), "spare", "e0", ["shard", "source_id"])
             .repartition(tasks, "shard", "source_id")
             .select("shard", F.explode(F.sequence(F.col("e0"), F.col("e0") + F.col("spare") - 1)).alias("e")))
    short = (wanted.join(drawn.groupBy("source_id").agg(F.sum("n").alias("n")), "source_id", "left").na.fill(0, ["n"])
             .filter("n < slots").withColumn("need", F.col("slots") - F.col("n"))
             .withColumn("e0", F.sum("need").over(Window.orderBy("source_id")) - F.col("need"))
             .withColumn("from", F.explode(F.sequence(F.col("e0"), F.col("e0") + F.col("need") - 1, F.lit(SLOTS_PER_TASK).cast("long"))))
             .repartition(tasks, "source_id", "from")
             .select("source_id", "n", "e0", F.explode(F.sequence(F.col("from"), F.least(
                 F.col("e0") + F.col("need"), F.col("from") + SLOTS_PER_TASK) - 1)).alias("e"))
             .select("source_id", (F.col("n") + F.col("e") - F.col("e0")).alias("j"), "e"))
    return kept.unionByName(spare.join(short, "e").select("shard", "source_id", "j"))


def place_blocks(slots: DataFrame, plan: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(shard, source_id, j, block, words): the block that fills each slot and the words it gives."""
    s = slots.join(plan, "source_id").withColumn("cycle", F.expr("j div blocks")).withColumn("at", F.expr("j % blocks"))
    key = (F.lit(seed), F.col("source_id"), F.col("cycle"))
    s = s.withColumn("block", permuted(F.col("at"), F.col("blocks"), key))
    whole = F.when(F.col("block") == F.col("blocks") - 1, F.col("short")).otherwise(F.lit(block))
    cut = (F.col("cycle") == F.col("passes")) & (F.col("at") == F.col("last_slots") - 1)
    return s.select("shard", "source_id", "j", "block",
                    F.when(cut, F.col("last_words")).otherwise(whole).alias("words"), whole.alias("length"))


def document_spans(sizes: DataFrame, targets: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Where each document's words lie in its source's stream: [lo, hi).

    Running sums are made per (source, bucket of the id's hash) and shifted by the buckets before, so a source
    with a third of all rows is spread over many tasks.
    """
    known = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    known = known.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)).cast("int"))
    part = known.groupBy("source_id", "bucket").agg(F.sum("size").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source_id").orderBy("bucket")) - F.col("_n")
    part = part.select("source_id", "bucket", before.alias("_before"))
    run = Window.partitionBy("source_id", "bucket").orderBy("doc_id", "size")
    rows = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (known.withColumn("row", F.row_number().over(run)).withColumn("_run", F.sum("size").over(rows))
            .join(part, ["source_id", "bucket"])
            .withColumn("hi", F.col("_before") + F.col("_run")).withColumn("lo", F.col("hi") - F.col("size"))
            .drop("_before", "_run"))


def words_taken(spans: DataFrame, placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """The spans' documents with the words the mix takes from each."""
    used = placed.groupBy("source_id", "block").agg(
        F.count_if(F.col("words") == F.col("length")).alias("full"),
        F.coalesce(F.max(F.when(F.col("words") < F.col("length"), F.col("words"))), F.lit(0)).alias("part"))
    of = F.when(F.col("size") > 0, F.sequence(F.expr(f"lo div {block}"), F.expr(f"(hi - 1) div {block}")))
    parts = (spans.withColumn("block", F.explode_outer(of))
             .withColumn("off", F.greatest(F.col("lo") - F.col("block") * block, F.lit(0)))
             .withColumn("len", F.least(F.col("hi"), (F.col("block") + 1) * block) - F.greatest(F.col("lo"), F.col("block") * block)))
    got = F.col("full") * F.col("len") + F.least(F.greatest(F.col("part") - F.col("off"), F.lit(0)), F.col("len"))
    keys = ["source_id", "bucket", "row", "doc_id", "size", "source_size", "target"]
    return (parts.join(used, ["source_id", "block"], "left").groupBy(*keys)
            .agg(F.coalesce(F.sum(got), F.lit(0)).cast("long").alias("taken")))


def mix(docs: DataFrame, block: int = BLOCK, slots_per_shard: int = SLOTS, seed: int = SEED):
    """(placed blocks, words taken per document) of the mix of ``docs`` (doc_id, source, text)."""
    sizes = materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size")),
                        "mix-sizes")
    targets = materialize(source_targets(sizes), "mix-targets")
    plan = materialize(plan_sources(targets, block, seed), "mix-plan")
    placed = place_blocks(draw_slots(plan, slots_per_shard, seed=seed), plan, block, seed)
    return placed, words_taken(document_spans(sizes, targets), placed, block)


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents as the mix takes them: dropped, kept or repeated.

    A document comes taken / size times; the fraction is rounded up or down by a hash of its id, so that the
    sources' words stay near their targets. A document without words stays as it is. Rows that share an id
    share the mean of what is taken of them.
    """
    _, taken = mix(docs, seed=seed)
    of, times = fresh(docs, "_of"), fresh(docs, "_times")
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    share = (taken.groupBy("doc_id").agg((F.sum("taken") / F.nullif(F.sum("size"), F.lit(0))).alias("x"))
             .select(F.col("doc_id").alias(of), F.coalesce(F.floor(F.col("x") + chance), F.lit(1)).cast("int").alias(times)))
    out = docs.join(share, docs["doc_id"].eqNullSafe(share[of])).filter(F.col(times) > 0)
    return out.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[docs[c] for c in docs.columns])


def op2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, taken = mix(documents(spark, sf_dir))
    return taken.select("doc_id", "size", "source_size", "target", "taken")
