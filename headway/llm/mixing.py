"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a fixed shuffled order (the MD5 of the doc_id), passed at
most ``passes`` times.  A document's virtual finish time is the running number of words of its queue
divided by the source's target.  All finish times are sorted globally (range partitioned) and the
sorted stream is cut where its running total would exceed the budget; ties stay together.

Running totals are two-level prefix sums: equal rows are counted first, the distinct ones are cut into
ranges of the whole shuffled order (doc_id's MD5, doc_id, size, text), summed per range, and finished inside
each range.  A source or a doc_id with a third of all rows is thereby many ranges, never one window; equal
rows are one row until they are dealt out, in blocks of ``RANGE_DOCS``.  Only one row per source, one per source and
range and one partition of a global sort meet a single task.

Defined cases: null text has size 0; documents of size 0 are never taken; null sources are one
source, sorted last; repeated rows are rows of their own; an empty table gives an empty result;
sources without words have target 0; other columns are ignored (``mix`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import prepare, rows_of, stored, unpack, word_counts

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
PASSES = 2
RANGE_DOCS = 2000


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
            passes: int = PASSES) -> DataFrame:
    """One row per source: number, size, documents and target (water filling under the caps)."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    everything = Window.partitionBy()                       # one row per source
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") - 1) % len(weights) + 1)
    by_ratio = Window.orderBy("ratio", "no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(float(budget)) * F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    step = (per.withColumn("no", F.row_number().over(named)).withColumn("weight", weight)
            .withColumn("cap", F.lit(passes) * F.col("source_size"))
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("total", F.sum("source_size").over(everything).cast("double"))
            .withColumn("level", level))
    # the first source that stays below its cap fixes the common level of all that follow
    open_ = step.withColumn("open", F.col("ratio") > F.col("level"))
    fixed = F.min(F.when(F.col("open"), F.struct("ratio", "no", "level"))).over(everything)["level"]
    return (open_.withColumn("fixed", fixed)
            .select("source", "no", "source_size", "n_docs",
                    F.when(F.col("fixed").isNull() | (F.col("ratio") <= F.col("fixed")), F.col("cap").cast("double"))
                    .otherwise(F.col("fixed") * F.col("weight")).alias("target")))


def queued(sized: DataFrame, per_source: DataFrame) -> DataFrame:
    """``sized(doc_id, sign, source, size)`` plus source figures and ``done``: words of the queue up to
    and including the document."""
    s = per_source.withColumnRenamed("source", "__source")
    rows = sized.groupBy("doc_id", "source", "sign", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = (rows.join(s, rows["source"].eqNullSafe(s["__source"])).drop("__source")
            .withColumn("turn", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    order = ("turn", "doc_id", "size", "sign")
    dealt = stored(rows.repartitionByRange("no", *order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    sums = dealt.groupBy("no", "range").agg(F.sum(F.col("size") * F.col("n")).alias("s"))
    run = Window.partitionBy("no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("no", "range", F.coalesce(F.sum("s").over(run), F.lit(0)).alias("base"))
    inner = Window.partitionBy("no", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = dealt.join(base, ["no", "range"]).withColumn(
        "before", F.col("base") + F.sum(F.col("size") * F.col("n")).over(inner) - F.col("size") * F.col("n"))
    # equal rows, one after another: blocks first, so that no task deals out all copies of one row
    blocks = upto.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RANGE_DOCS).cast("long"))))
    blocks = blocks.repartition("no", *order, "block")
    each = blocks.withColumn("nth", F.explode(F.sequence(
        F.col("block") + 1, F.least(F.col("block") + RANGE_DOCS, F.col("n")))))
    return each.withColumn("done", F.col("before") + F.col("size") * F.col("nth")).drop("n", "before", "block", "nth")


def _finish(k: int) -> Column:
    return (F.col("done") + F.lit(k) * F.col("source_size")).cast("double") / F.col("target")


def cut_time(queue: DataFrame, budget: float = BUDGET, passes: int = PASSES) -> float | None:
    """The last virtual finish time whose running total over the global order is within the budget."""
    times = (queue.where("size > 0 and target > 0")
             .select("size", F.explode(F.array(*[_finish(k) for k in range(passes)])).alias("finish")))
    ordered = times.repartitionByRange("finish").sortWithinPartitions("finish")
    placed = stored(ordered.withColumn("part", F.spark_partition_id()), "mix-times")
    limit = F.lit(float(queue.agg(F.sum("size")).first()[0] or 0) * budget)
    per = placed.groupBy("part").agg(F.sum("size").alias("s"), F.max("finish").alias("last"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # a row per partition
    per = per.withColumn("upto", F.sum("s").over(upto))
    fits = F.col("upto") <= limit
    head = per.agg(F.max(F.when(fits, F.col("last"))).alias("t"), F.max(F.when(fits, F.col("upto"))).alias("u"),
                   F.min(F.when(~fits, F.col("part"))).alias("part")).first()
    if head["part"] is None:
        return head["t"]
    inner = Window.orderBy("finish").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rest = (placed.where(F.col("part") == head["part"])
            .withColumn("upto", F.sum("size").over(inner) + F.lit(head["u"] or 0))
            .where(F.col("upto") <= limit).agg(F.max("finish").alias("t")).first())
    return rest["t"] if rest["t"] is not None else head["t"]


def mixed(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
          passes: int = PASSES) -> DataFrame:
    """``sized`` plus source_size, target and ``copies`` (times the document is taken)."""
    per_source = stored(targets(sized, weights, budget, passes), "mix-sources")
    queue = stored(queued(sized, per_source), "mix-queue")
    t = cut_time(queue, budget, passes)
    taken = F.lit(0)
    if t is not None:
        taken = sum((F.when((F.col("size") > 0) & (F.col("target") > 0) & (_finish(k) <= F.lit(t)), 1).otherwise(0)
                     for k in range(passes)), F.lit(0))
    return queue.withColumn("copies", taken)


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    prepare(docs.sparkSession)
    sign = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("sign")
    sized = stored(word_counts(docs, ["doc_id", "source", sign]), "mix-sizes")
    return mixed(sized).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
        passes: int = PASSES) -> DataFrame:
    """The mixed table: every taken document as often as it is taken, columns as given."""
    prepare(docs.sparkSession)
    sign = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    sized = stored(word_counts(docs, ["doc_id", "source", sign.alias("sign")]), "mix-sizes")
    copies = (mixed(sized, weights, budget, passes).where("copies > 0")
              .groupBy("doc_id", "sign").agg(F.sum("copies").cast("int").alias("__copies"))
              .withColumnsRenamed({"doc_id": "__id", "sign": "__sign"}))
    keyed = docs.select(rows_of(docs), F.col("doc_id").alias("__doc"), sign.alias("__sign"))
    hit = keyed.join(copies, (keyed["__doc"].eqNullSafe(copies["__id"])) & (keyed["__sign"] == copies["__sign"])) \
        .select("__row", "__doc", keyed["__sign"], "__copies")
    one = hit.dropDuplicates(["__doc", "__sign"])       # rows equal in all columns were added up above
    return unpack(one.withColumn("__n", F.explode(F.array_repeat(F.lit(1), F.col("__copies")))), docs.columns)
