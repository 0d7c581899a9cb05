"""Prefix search of a table of tokens in a vocabulary, as ranges of one sorted list."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from statcube.operators.scoring import PREFIX_WEIGHT
from statcube.session import cut_lineage

# Pairs handed on at once.
PAIRS = 10_000


def expand_prefix(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Terms reached by each query token: itself, else at half weight those it prefixes.

    Tokens and terms are sorted together, range-partitioned.  The terms that start with a token follow it without
    a gap, so one walk over each partition finds them: it holds the tokens that the current text starts
    with, which are prefixes of each other.  A token whose range goes on in later partitions is a prefix of
    their first text; these few are found from the first texts and given to the walk.  No row is made for
    a prefix, however long a term is.  Runs jobs when called; the sorted list is checkpointed.
    """
    asked = tokens.select(F.col("token").alias("text"), F.lit(False).alias("is_term"))
    terms = vocabulary.select(F.col("term").alias("text"), F.lit(True).alias("is_term"))
    both = asked.unionByName(terms).where("text <> ''").distinct()
    # By text alone, so that a token and the equal term share a partition; the token comes first.
    line = cut_lineage(both.repartitionByRange("text").sortWithinPartitions("text", "is_term"))
    carried = _carried(line)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(carried.get(TaskContext.get().partitionId(), ()))
        pairs: list[tuple[str, str, float]] = []
        for batch in batches:
            for text, is_term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                while held and not text.startswith(held[-1]):
                    held.pop()
                if not is_term:
                    held.append(text)
                elif held and held[-1] == text:
                    # A token that is a term reaches only itself.
                    pairs.append((held.pop(), text, 1.0))
                    pairs.extend((token, text, PREFIX_WEIGHT) for token in held)
                else:
                    pairs.extend((token, text, PREFIX_WEIGHT) for token in held)
                if len(pairs) >= PAIRS:
                    yield _batch(pairs)
                    pairs = []
        yield _batch(pairs)

    def _batch(pairs: list[tuple[str, str, float]]) -> pa.RecordBatch:
        token, term, weight = zip(*pairs) if pairs else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(token, pa.string()), pa.array(term, pa.string()), pa.array(weight, pa.float64())], names=["token", "term", "weight"])

    return line.mapInArrow(run, "token string, term string, weight double")


def _carried(line: DataFrame) -> dict[int, list[str]]:
    """Per partition, the tokens from earlier partitions that its first text starts with, shortest first.

    One text per partition is looked at; its prefixes are cut at the longest token.
    """
    numbered = line.withColumn("part", F.spark_partition_id())
    firsts = numbered.groupBy("part").agg(F.min("text").alias("first"))
    longest = line.where(~F.col("is_term")).agg(F.coalesce(F.max(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.length("first"), F.lit(max(longest, 1))))).alias("n")
    starts = firsts.select("part", "first", lengths).select("part", F.substring("first", F.lit(1), F.col("n")).alias("text"))
    # Those found as a whole term reach only themselves.
    near = numbered.join(starts.select("text").distinct(), "text", "left_semi")
    found = near.groupBy("text").agg(F.max("is_term").alias("is_term"), F.min("part").alias("home"))
    open_tokens = starts.join(found.where(~F.col("is_term")), "text").where("home < part").select("part", "text").collect()
    carried: dict[int, list[str]] = {}
    for row in sorted(open_tokens, key=lambda r: len(r["text"])):
        carried.setdefault(row["part"], []).append(row["text"])
    return carried
