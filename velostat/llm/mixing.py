"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Sources get word targets: a share of the budget by weight, at most ``max_repeat``
times the source's size, what is cut off going to the others by weight.  Every
document of a source expects ``target / source size`` copies; the prefix sum of
these, in the order of size inside the source, plus one random offset per source
crosses an integer as often as the document is emitted.  Going through the
documents by size makes the words taken come near the target, since each stretch
of equal sizes gives its share.

Defined results: NULL source is a source of its own, last in order; NULL or empty
text has size 0 (it takes no words, but is emitted like any other); rows with the
same doc_id are documents of their own; an empty table gives an empty one.  A
source of size 0 has target 0 and emits nothing.  Columns of the input keep their
names; the operator's own win a clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velostat.llm.common import stage, text_or_empty, words

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_REPEAT = 2.0
# Documents of one source and size class are dealt to blocks of about this many.
BLOCK_ROWS = 20_000
_CELL = ("_src", "_null", "_class", "_block")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(_src, _null, source_size, target) from one row (_src, _null, source_size) per source.

    Sharing the excess again and again until no source is over its limit ends
    at one level: target = min(limit, level * weight).  The sources at their
    limit are those with the smallest limit per weight, so the level comes from
    prefix sums over the sources in that order.  One row per source, so the
    unpartitioned windows see little data."""
    by_name = Window.orderBy("_null", "_src")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_k"), F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("_k", F.row_number().over(by_name) - 1).withColumn("_w", weight)
    s = s.withColumn("_limit", F.lit(max_repeat) * F.col("source_size"))
    order = Window.orderBy(F.col("_limit") / F.col("_w"), "_null", "_src")
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn(
        "_level",
        (F.lit(budget) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        / F.sum("_w").over(rest),
    )
    # the first source, in this order, that its limit does not hold back sets the level
    free = F.when(F.col("_level") * F.col("_w") <= F.col("_limit"), F.col("_level"))
    s = s.withColumn("_final", F.first(free, ignorenulls=True).over(everything))
    target = F.coalesce(F.least(F.col("_limit"), F.col("_final") * F.col("_w")), F.col("_limit"))
    return s.select("_src", "_null", "source_size", target.cast("double").alias("target"))


def mixing_plan(
    docs: DataFrame, carry: str = "*", seed: int = 42, weights=WEIGHTS, budget=BUDGET, max_repeat=MAX_REPEAT
) -> DataFrame:
    """One row per document: the columns named by ``carry`` as a struct ``_row``,
    with size, source_size, target and copies.

    No source is gathered: the running number of a document is the sum of the
    rows in smaller size classes of its source, of the rows in earlier blocks of
    its class, and its own number inside its block of ``BLOCK_ROWS`` rows."""
    text = text_or_empty("text")
    own = docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_src"),
        F.col("source").isNull().alias("_null"),
        word_count(text).alias("size"),
        F.xxhash64(F.col("doc_id"), text).alias("_key"),
        F.struct(carry).alias("_row"),
    ).withColumn("_class", F.floor(F.log2(F.col("size") + 1) * 8).cast("int"))
    own = stage(own, "mix-sized")
    facts = own.groupBy("_src", "_null").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    n_blocks = F.greatest(F.lit(1), F.ceil(own.select(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).scalar())).cast("bigint")
    own = own.withColumn("_block", F.pmod(F.xxhash64(F.col("_key"), F.lit(seed)), n_blocks))
    targets = source_targets(facts.select("_src", "_null", "source_size"), weights, budget, max_repeat)

    cells = own.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_rows"))
    blocks_before = Window.partitionBy("_src", "_null", "_class").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_in_class", F.coalesce(F.sum("_rows").over(blocks_before), F.lit(0)))
    classes = own.groupBy("_src", "_null", "_class").agg(F.count(F.lit(1)).alias("_rows"))
    classes_before = Window.partitionBy("_src", "_null").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("_in_source", F.coalesce(F.sum("_rows").over(classes_before), F.lit(0))).drop("_rows")
    places = cells.drop("_rows").join(classes, ["_src", "_null", "_class"]).join(targets, ["_src", "_null"])

    inside = Window.partitionBy(*_CELL).orderBy("size", "_key")
    numbered = own.withColumn("_number", F.row_number().over(inside)).join(places, list(_CELL))
    index = F.col("_in_source") + F.col("_in_class") + F.col("_number")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.pmod(F.xxhash64(F.col("_src"), F.col("_null"), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    copies = F.floor(offset + rate * index) - F.floor(offset + rate * (index - 1))
    return numbered.select(
        "_row", "size", "source_size", "target", F.least(copies, F.ceil(rate)).cast("bigint").alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the plan says, same columns."""
    plan = mixing_plan(docs, **options)
    return plan.where(F.col("copies") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


def mixing_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    plan = mixing_plan(docs, carry="doc_id", **options)
    return plan.select(
        F.col("_row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )
