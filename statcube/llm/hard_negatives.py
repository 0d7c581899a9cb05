"""Hard negatives by Kronecker-packed products.

Vectors become integers; a row's score is its exact inner product with the anchor.  Components of several
candidates are biased to be positive and put side by side into one wide integer, each in a field wide
enough for a whole sum.  One multiplication per anchor component then serves all of them: the sum of the products holds one
biased score in each field.  While two fields or more fit into the 53 bits that a double holds exactly,
the wide integers are doubles and the products one matrix product; wider ranges use Python integers of 64 fields.

Anchors and candidates meet in blocks of bounded size, on the executors: blocks of anchors are broadcast while their
measured size is small; beyond it, pairs of (anchor block, group of candidate blocks) are dealt out by a shuffle.
A block hands on only the best rows per anchor, which a cut ranking then joins.

Defined cases: rows whose id, label or vector is null, or whose vector has a null or non-finite component, take no part;
missing components of shorter vectors count as 0; "other" rows are rows with another id; equal anchor rows give their result once each;
equal scores go by the smaller id; an anchor without positives, or a positive without negatives in its window, gives no
rows; a score that does not fit into 64 bits is an error; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from statcube.session import cut_lineage

ANCHORS, CANDIDATES = 2048, 4096
# Candidate blocks that one task meets in the shuffled join.
GROUP = 16
BROADCAST_BYTES = 32 * 1024 * 1024
# Anchors scored at once, which bounds the table of scores in memory.
AT_ONCE = 256
EXACT_BITS = 53
WIDE_FIELDS = 64


@dataclass(frozen=True)
class Packing:
    """How components become fields: the bias, the width of a field and the number of fields."""

    size: int  # components of a vector
    least: int  # smallest component, at most 0
    bits: int
    fields: int
    wide: bool

    @classmethod
    def of(cls, size: int, least: int, most: int) -> Packing:
        least, most = min(least, 0), max(most, 0)
        bits = max(1, (size * (most - least) ** 2).bit_length())
        wide = 2 * bits > EXACT_BITS
        return cls(size, least, bits, WIDE_FIELDS if wide else EXACT_BITS // bits, wide)

    def matrix(self, vectors: list[list[int]]) -> np.ndarray:
        """Vectors as biased rows, filled with zeros."""
        out = np.full((len(vectors), self.size), -self.least, object if self.wide else np.int64)
        for row, vector in zip(out, vectors):
            row[:len(vector)] = [v - self.least for v in vector]
        return out

    def pack(self, biased: np.ndarray) -> np.ndarray:
        """Candidates as wide integers: one row per component, ``fields`` candidates to a number."""
        count = -(-len(biased) // self.fields)
        padded = np.zeros((count * self.fields, self.size), biased.dtype)
        padded[:len(biased)] = biased
        shifts = np.array([1 << self.bits * j for j in range(self.fields)], biased.dtype)
        words = (padded.reshape(count, self.fields, self.size) * shifts[None, :, None]).sum(axis=1).T
        return words if self.wide else words.astype(np.float64)

    def scores(self, anchors: np.ndarray, words: np.ndarray, candidates: np.ndarray, n: int) -> np.ndarray:
        """Exact scores of biased anchors with ``n`` packed candidates, of which the sums of biased components are given."""
        sums = anchors.astype(words.dtype) @ words
        mask = (1 << self.bits) - 1
        if self.wide:
            fields = np.array([[s >> self.bits * j & mask for s in row for j in range(self.fields)] for row in sums], object)
        else:
            whole = sums.astype(np.int64)
            fields = np.stack([whole >> self.bits * j & mask for j in range(self.fields)], axis=2)
        biased = fields.reshape(len(anchors), -1)[:, :n]
        # The bias added least once to each factor.
        exact = biased + self.least * (anchors.sum(axis=1)[:, None] + candidates[None, :]) + self.size * self.least**2
        return exact.astype(np.int64)


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the k best allowed scores of each row; ties go by column."""
    floor = np.iinfo(np.int64).min
    if scores.shape[1] > k:
        cut = np.partition(np.where(allowed, scores, floor), scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        allowed = allowed & (scores >= cut[:, None])
    rows, columns = np.nonzero(allowed)
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    return rows[place < k], columns[place < k]


def _vectors(rows: DataFrame, anchor: Column, scale: int) -> DataFrame:
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return usable.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("x"), anchor.alias("is_anchor"))


def _candidate_blocks(vectors: DataFrame, packing: Packing) -> DataFrame:
    """Rows of packed candidates in the order of their ids; ``at`` tells blocks of a partition apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            for start in range(0, batch.num_rows, CANDIDATES):
                some = batch.slice(start, CANDIDATES)
                ids, labels = some.column(0).to_numpy(), some.column(1).to_numpy()
                order = np.argsort(ids, kind="stable")
                biased = packing.matrix(some.column(2).to_pylist())[order]
                words = packing.pack(biased)
                packed = pickle.dumps((ids[order], labels[order], words, biased.sum(axis=1)), 5)
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([packed], pa.binary())], names=["at", "candidates"])
                at += 1

    packed = vectors.select("vec_id", "label", "x").mapInArrow(run, "at long, candidates binary")
    return packed.select((F.spark_partition_id() + F.col("at")).alias("at"), "candidates")


def _anchor_blocks(vectors: DataFrame, packing: Packing, n_blocks: int) -> DataFrame:
    """block and its anchors, packed; equal rows are one anchor with a number of copies."""
    equal = vectors.where("is_anchor").groupBy("vec_id", "label", "x").agg(F.count("*").alias("copies"))
    dealt = equal.withColumn("block", F.pmod(F.xxhash64("vec_id", "x"), F.lit(n_blocks)))

    def pack(group: pa.Table) -> pa.Table:
        columns = [group.column(c).to_numpy() for c in ("vec_id", "label", "copies")]
        packed = pickle.dumps((*columns, packing.matrix(group.column("x").to_pylist())), 5)
        return pa.table({"block": group.column("block")[:1], "anchors": pa.array([packed], pa.binary())})

    return dealt.groupBy("block").applyInArrow(pack, "block long, anchors binary")


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _meet(candidates: DataFrame, anchors: DataFrame, n_blocks: int, n_groups: int) -> DataFrame:
    """Each block of candidates next to each block of anchors."""
    measured = anchors.agg(*[F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).alias(c) for c in anchors.columns if c != "block"]).first()
    every_block = candidates.withColumn("block", _numbers(n_blocks))
    if sum(measured) <= BROADCAST_BYTES:
        return every_block.join(F.broadcast(anchors), "block")
    grouped = every_block.withColumn("part", F.pmod(F.xxhash64("at", F.xxhash64("candidates")), F.lit(n_groups)).cast("long"))
    copies = anchors.withColumn("part", _numbers(n_groups))
    return grouped.join(copies, ["block", "part"])


def _positives(met: DataFrame, packing: Packing, k: int) -> DataFrame:
    """block, slot of the anchor, place from 0, score, other: the k best other rows of the anchor's label."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed, left in zip(batch.column("block").to_pylist(), batch.column("candidates"), batch.column("anchors")):
                ids, labels, words, sums = pickle.loads(packed.as_buffer())
                own_ids, own_labels, _, biased = pickle.loads(left.as_buffer())
                for start in range(0, len(own_ids), AT_ONCE):
                    some = slice(start, start + AT_ONCE)
                    scores = packing.scores(biased[some], words, sums, len(ids))
                    allowed = (own_labels[some, None] == labels) & (own_ids[some, None] != ids)
                    rows, columns = _best(scores, allowed, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), block)), pa.array(rows + start), pa.array(scores[rows, columns]), pa.array(ids[columns])],
                        names=["block", "slot", "score", "other"])

    found = met.mapInArrow(run, "block long, slot long, score long, other long")
    best = W.partitionBy("block", "slot").orderBy(F.desc("score"), "other")
    return found.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < k)


def _with_positives(anchors: DataFrame, positives: DataFrame) -> DataFrame:
    """Anchor blocks with the slots, places, scores and ids of their positives."""

    def pack(group: pa.Table) -> pa.Table:
        columns = [group.column(c).to_numpy().astype(np.int64) for c in ("slot", "place", "score", "other")]
        return pa.table({"block": group.column("block")[:1], "positives": pa.array([pickle.dumps(columns, 5)], pa.binary())})

    return anchors.join(positives.groupBy("block").applyInArrow(pack, "block long, positives binary"), "block")


def _negatives(met: DataFrame, packing: Packing, k: int, low: int, high: int) -> DataFrame:
    """The k best rows of other labels for each positive whose score lies in the positive's window."""
    fields = ("block", "slot", "place", "anchor_id", "copies", "positive_id", "positive_score", "negative_id", "negative_score")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column("block").to_pylist(), batch.column("candidates"), batch.column("anchors"), batch.column("positives"))
            for block, packed, left, asked in zip(*columns):
                ids, labels, words, sums = pickle.loads(packed.as_buffer())
                own_ids, own_labels, copies, biased = pickle.loads(left.as_buffer())
                slot, place, score, other = pickle.loads(asked.as_buffer())
                least = np.array([-(-low * s // 100) for s in score.tolist()])
                most = np.array([high * s // 100 for s in score.tolist()])
                for start in range(0, len(own_ids), AT_ONCE):
                    mine = slice(start, start + AT_ONCE)
                    scores = packing.scores(biased[mine], words, sums, len(ids))
                    differing = (own_labels[mine, None] != labels) & (own_ids[mine, None] != ids)
                    here = (slot >= start) & (slot < start + AT_ONCE)
                    for p in np.unique(place[here]):
                        at = np.flatnonzero(here & (place == p))
                        own = slot[at] - start
                        window = (scores[own] >= least[at, None]) & (scores[own] <= most[at, None]) & differing[own]
                        rows, found = _best(scores[own], window, k)
                        at = at[rows]
                        values = (np.full(len(at), block), slot[at], place[at], own_ids[slot[at]], copies[slot[at]],
                                  other[at], score[at], ids[found], scores[own][rows, found])
                        yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in values], names=list(fields))

    found = met.mapInArrow(run, ", ".join(f"{f} long" for f in fields))
    best = W.partitionBy("block", "slot", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and embedding; ``anchor`` says which rows are anchors.  A negative's score lies between ``low`` and ``high``
    percent of its positive's.  Runs jobs when called; the blocks of anchors are checkpointed.
    """
    vectors = _vectors(rows, anchor, scale)
    shape = vectors.agg(
        F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors"), F.max(F.size("x")).alias("size"),
        F.min(F.array_min("x")).alias("least"), F.max(F.array_max("x")).alias("most")).first()
    packing = Packing.of(shape["size"] or 0, shape["least"] or 0, shape["most"] or 0)
    n_blocks = max(1, ceil(shape["anchors"] / ANCHORS))
    n_groups = max(1, ceil(shape["n"] / (GROUP * CANDIDATES)))
    candidates = _candidate_blocks(vectors, packing)
    anchors = cut_lineage(_anchor_blocks(vectors, packing, n_blocks))
    near = _positives(_meet(candidates, anchors, n_blocks, n_groups), packing, positives)
    anchors = cut_lineage(_with_positives(anchors, near))
    found = _negatives(_meet(candidates, anchors, n_blocks, n_groups), packing, negatives, low, high)
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
