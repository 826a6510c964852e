"""Operator 1, mixing sources to target weights (DataFrame functions only).

Efraimidis-Spirakis sampling: every document draws an exponential key
``-ln(u) / quality``; each source reads its documents in key order and takes
them until its token budget is met. A budget of several source sizes first
takes the whole source that many times (complete epochs), and only the rest
is drawn.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating.
They share all words; no target exceeds ``max_epochs`` times its source, and
the excess is shared again by weight among the others until none is above.

Defined results: a null or empty text has size 0 and takes nothing; an empty
table gives an empty table; a null source is a source of its own, the last;
rows without a doc_id, or that share one, draw by their texts; rows equal in
doc_id, text and source are taken or left together; the last document (or
group of equal rows) drawn is the one that brings the total nearest to the
budget. Columns of the input that clash with the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WORD, running_totals, staged

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Quality is the number of letter runs per word, held within these bounds.
LEAST_QUALITY = 0.1
ADDED = ("size", "source_size", "target", "copies", "taken")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    runs = F.coalesce(F.regexp_count(text, F.lit(r"\p{L}{2,}")), F.lit(0))
    return F.greatest(F.lit(LEAST_QUALITY), F.least(F.lit(1.0), runs / F.greatest(size, F.lit(1))))


def draw_key(doc_id: Column, text: Column, quality: Column, seed: int) -> Column:
    """-ln(u) / quality with u in (0, 1] from the first 52 bits of an MD5 of the id and the text."""
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    bits = F.conv(F.substring(F.md5(drawn), 1, 13), 16, 10)
    u = (bits.cast("double") + 1) / F.lit(float(2**52))
    return -F.log(u) / quality


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with ``target``: words shared by weight, capped at ``max_epochs`` sizes.

    In ascending order of cap per unit of weight, the capped sources come
    first; the level is what is left over the weight that is left.
    """
    ranked = running_totals(sources, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)})
    weighed = ranked.withColumn("weight", F.element_at(
        F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))).drop("rank")
    cap = F.col("source_size") * max_epochs
    filled = staged(running_totals(weighed, [(cap / F.col("weight")).asc(), F.col("source").asc_nulls_last()],
                                   {"cap_before": cap, "weight_before": F.col("weight")}), "sources")
    total = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # The first source whose cap lies above the level of its place sets the level of all that follow.
    left, weight_left = F.lit(total[0]) - F.col("cap_before"), F.lit(total[1]) - F.col("weight_before")
    level = filled.filter(cap * weight_left >= F.col("weight") * left).agg(
        F.min(F.struct("cap_before", "weight_before", left.alias("left"), weight_left.alias("weight_left")))).first()[0]
    if level is None:  # no source at all
        return filled.select("source", "source_size", cap.cast("double").alias("target"))
    capped = F.struct("cap_before", "weight_before") < F.struct(
        F.lit(level["cap_before"]).alias("cap_before"), F.lit(level["weight_before"]).alias("weight_before"))
    share = F.col("weight") * F.lit(level["left"]) / F.lit(level["weight_left"])
    return filled.select("source", "source_size", F.when(capped, cap.cast("double")).otherwise(
        F.least(cap.cast("double"), share)).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 1) -> DataFrame:
    """``docs`` with size, source_size, target, copies (times the mix takes the document) and taken words."""
    docs = docs.drop(*ADDED)
    size = size_of(F.col("text"))
    key = draw_key(F.col("doc_id"), F.col("text"), quality_of(F.col("text"), size), seed)
    drawn = staged(docs.select("doc_id", "source", size.alias("size"), key.alias("key")), "keys")
    sources = drawn.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, max_epochs)
    plan = staged(targets.select(
        F.col("source").alias("_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).alias("epochs"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "plan")
    order = [F.col("key").asc(), F.col("doc_id").asc_nulls_first()]
    # Equal rows, however many, are one entry of the order.
    entries = drawn.filter("size > 0").groupBy("source", "key", "doc_id").agg(F.sum("size").alias("words"))
    before = running_totals(entries, order, {"before": F.col("words")}, ["source"])
    cut = (before.join(plan, F.col("source").eqNullSafe(F.col("_source")))
           .filter((F.col("rest") > 0) & (F.col("before") + F.col("words") / 2 <= F.col("rest")))
           .groupBy(F.col("source").alias("_cut_source")).agg(F.max(F.struct("key", "doc_id")).alias("cut"), F.lit(True).alias("drawn")))
    plan = staged(plan.join(cut, F.col("_source").eqNullSafe(F.col("_cut_source")), "left").drop("_cut_source"), "cuts")
    mine = F.struct(key.alias("key"), F.col("doc_id"))
    # The row travels as one column, so no name of the input meets one of the plan.
    out = docs.select(F.struct(*docs.columns).alias("row"), "source", size.alias("size"), mine.alias("mine")).join(plan, F.col("source").eqNullSafe(F.col("_source")))
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.when(F.col("drawn") & (F.col("mine") <= F.col("cut")), 1).otherwise(0)).otherwise(F.lit(0)).cast("long")
    return (out.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
            .select("row.*", *ADDED))
