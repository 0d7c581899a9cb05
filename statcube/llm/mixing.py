"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words.  A document's expected copies are its source's rate
``target / size``; their prefix sum within the source plus one random offset says how often the
document is emitted: once for each integer boundary the sum crosses.  Documents stand in a
serpentine order of size within chunks, so the words taken stay within a few documents of the target.

A prefix sum over a source needs an order over all its rows, which one task can't hold.  Sources
are therefore cut into chunks of about ``CHUNK_ROWS`` rows by a hash of the id: rows are ranked
inside their chunk, and the chunk's first rank is the number of rows in the chunks before it.

Defined cases: a null text has size 0; null sources form one source, last in order; a source without
words has target 0 and takes nothing; rows that repeat are separate rows; an empty table gives an
empty mix.  Other columns pass through; columns called like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from statcube.llm.common import fraction_of, text_of, word_count
from statcube.session import broadcast_within, cut_lineage

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
CHUNK_ROWS = 2000
SEED = "mix"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """One row per source: key, source, n_rows, source_size, target.

    Sources by code point share all words by their weights.  A target stops at ``cap`` times the
    source's size; what is over goes to the others by weight, again and again.  That ends at one
    water level per unit of weight: sources whose cap lies below it get their cap, all others
    their weight times the level.  Both windows run over one row per source.
    """
    per_source = sized.groupBy("key", "source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), position + 1).cast("long"))
    # cap / weight ascending; compared as products of integers by one common multiple of the weights.
    common = 1
    for w in set(weights):
        common *= w
    weighed = weighed.withColumn("ratio", F.col("source_size") * F.floor(F.lit(common) / F.col("weight")))
    upto = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    levels = (
        weighed.withColumn("capped", F.sum(F.col("source_size") * cap).over(upto))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.sum("weight").over(upto))
        .withColumn("total", F.sum("source_size").over(everything))
    )
    # A source stays capped while its cap is at most its share once those up to it are capped.
    full = F.col("source_size") * cap * F.col("left_weight") <= F.col("weight") * (F.col("total") - F.col("capped"))
    levels = levels.withColumn("is_capped", full | (F.col("source_size") == 0))
    rest = F.sum(F.when(~F.col("is_capped"), F.col("weight"))).over(everything)
    used = F.sum(F.when(F.col("is_capped"), F.col("source_size") * cap).otherwise(0)).over(everything)
    share = F.col("weight") * ((F.col("total") - used).cast("double") / rest.cast("double"))
    target = F.when(F.col("is_capped"), (F.col("source_size") * cap).cast("double")).otherwise(share)
    return levels.select("key", "source", "n_rows", "source_size", target.alias("target"))


def _rank_in_source(sized: DataFrame, targets: DataFrame, chunk_rows: int) -> DataFrame:
    """Adds targets and ``rank``, the row's place in its source, from 1 on.

    ``sized`` has row, key, doc_id, size; ``targets`` has one row per key and is sent to every task
    only when it is measured to be small.
    """
    chunks = F.ceil(F.col("n_rows") / chunk_rows)
    chunk = F.floor(fraction_of(F.col("doc_id"), f"{SEED}:chunk") * chunks)
    placed = sized.join(broadcast_within(targets), "key").withColumn("chunk", chunk)
    serpentine = F.when(F.col("chunk") % 2 == 0, F.col("size")).otherwise(-F.col("size"))
    within = Window.partitionBy("key", "chunk").orderBy(serpentine, F.col("doc_id"))
    ranked = placed.withColumn("place", F.row_number().over(within))
    before = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("key", "chunk").count()
    starts = counts.select("key", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return ranked.join(starts, ["key", "chunk"]).withColumn("rank", F.col("start") + F.col("place"))


def boundaries_crossed(rank: Column, rate: Column, offset: Column) -> Column:
    """Integers in (offset + rate * (rank - 1), offset + rate * rank]."""
    return F.floor(offset + rate * rank.cast("double")) - F.floor(offset + rate * (rank - 1).cast("double"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES, chunk_rows: int = CHUNK_ROWS,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The documents with size, source_size, target and ``copies``, how often the mix emits each.

    ``carry`` names the columns that travel with the ranks; all of them if null.  Runs one job when called: the targets need the sizes of all sources.
    """
    own = ("size", "source_size", "target", "copies")
    sized = docs.select(
        F.struct(*[c for c in (docs.columns if carry is None else carry) if c not in own]).alias("row"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("key"),
        "source", "doc_id", word_count(text_of()).alias("size"))
    targets = cut_lineage(source_targets(sized, weights, cap))
    ranked = _rank_in_source(sized.drop("source"), targets, chunk_rows)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(0.0)
    copies = boundaries_crossed(F.col("rank"), rate, fraction_of(F.col("source"), SEED))
    return ranked.select("row.*", "size", "source_size", "target", F.least(copies, F.lit(cap)).cast("long").alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document once per copy, numbered by ``copy_no`` from 1 on."""
    taken = mixed.where("copies > 0")
    return taken.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")
