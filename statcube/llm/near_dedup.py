"""Near-duplicates by b-bit MinHash.

A document's set holds its distinct 5-word shingles.  Each set gets minima under many hash functions; bands of them
find candidates, and only the low ``BITS`` bits of each minimum are kept, packed into integers.  The
share of equal bit groups, corrected for groups that agree by chance, estimates the similarity of a
candidate pair; what is not clearly below the threshold is confirmed on the full sets.

Documents with equal sets are one class and enter once.  In a bucket of a band every class is first
compared with the bucket's smallest one.  Once these links are joined to components, only pairs of
different components that share a bucket are left.  Documents whose own shingles rule out any link are
set aside, the others get signatures of more minima, and all their pairs are compared by these bits.  So no link between components is
lost, and a bucket of many copies costs one pair per copy.

The number of bands of 4 minima follows from the threshold: 20 at 85 and 28 at 80 percent, so that a pair at the threshold
is missed by all bands with probability 4e-7.  The screens by bits lose another 2e-7 of such pairs.

Defined cases: a null or empty text has no shingles and is linked with nothing; fewer words than a
shingle make one shingle; rows that repeat an id are judged each by its own text; a row without id
has no component and is kept; an empty table gives no rows.  ``deduplicate`` takes rows equal in id and text as one
document and keeps the smallest of them by their other columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from statcube.llm.graph import components
from statcube.llm.wordhash import mixed, windows, word_hashes
from statcube.session import broadcast_within, cut_lineage

SHINGLE = 5
PERCENT = 85
ROWS = 4
# Share of pairs at the threshold that all bands may miss.
MISSED = 5e-7
BITS = 4
PER_LONG = 64 // BITS
# Minima of the sharper signatures that open documents get.
SHARP = 1024
# Standard errors that an estimate may lie below the threshold.
ERRORS = 6
# Shingles times hash functions worked on at once.
CELLS_AT_ONCE = 4096 * 80

_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, SHARP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FIELDS = "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>, bits array<long>"


def shingle_hashes(text: str) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, lower-cased in A-Z."""
    words = word_hashes(text.encode().lower())
    if 0 < len(words) < SHINGLE:
        return windows(words, len(words), first=len(words) * SHINGLE)
    return np.unique(windows(words, SHINGLE))


def bands_for(percent: int) -> int:
    """Bands that miss a pair at the threshold rarely enough; their minima fill whole integers."""
    n = ceil(log(MISSED) / log(1 - (percent / 100) ** ROWS))
    step = PER_LONG // ROWS
    return -(-n // step) * step


def minima(shingles: np.ndarray, n: int) -> np.ndarray:
    """The smallest value of a set under each of ``n`` hash functions."""
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, CELLS_AT_ONCE // n)
    for at in range(0, len(shingles), step):
        block = shingles[at:at + step, None] * _SEEDS[:n]
        np.minimum(least, (block ^ (block >> np.uint64(31))).min(axis=0), out=least)
    return least


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, ``PER_LONG`` to an integer."""
    low = (least & np.uint64(2**BITS - 1)).reshape(-1, PER_LONG)
    return (low << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(1, len(least) // ROWS + 1, dtype=np.uint64)
    for row in least.reshape(-1, ROWS).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (identity of the set), band keys and packed bits of every row."""
    n = bands_for(percent) * ROWS
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
        ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[object]] = [[], [], [], []]
            for text in batch.column(1):
                shingles = shingle_hashes(text.as_py() or "")
                least = minima(shingles, n)
                row = (
                    len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None,
                    band_keys(least).view(np.int64) if len(shingles) else [],
                    packed_bits(least).view(np.int64) if len(shingles) else [])
                for column, value in zip(columns, row):
                    column.append(value)
            arrays = [pa.array(c, schema.field(i + 2).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text", _text_key()).mapInArrow(run, _FIELDS)


def _text_key() -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64("text").alias("text_key")


def estimated(a: Column, b: Column, n: int) -> Column:
    """Similarity by bit counts over ``n`` packed groups, corrected for chance agreement.

    One lambda over the integers, so that the plan does not grow with their number.
    """
    ones = F.lit(int("1" * PER_LONG, 16))

    def differences(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        any_bit = z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseOR(F.shiftrightunsigned(z, 3))
        return F.bit_count(any_bit.bitwiseAND(ones))

    differing = F.aggregate(F.zip_with(a, b, differences), F.lit(0), lambda total, d: total + d)
    chance = 2.0**-BITS
    return (1 - differing / float(n) - chance) / (1 - chance)


def least_estimate(n: int, percent: int = PERCENT) -> float:
    """The threshold less some standard errors of an estimate from ``n`` groups of bits."""
    agree = 2.0**-BITS + (1 - 2.0**-BITS) * percent / 100
    return percent / 100 - ERRORS * (agree * (1 - agree) / n) ** 0.5 / (1 - 2.0**-BITS)


def _possible(a: str, b: str, percent: int) -> Column:
    """Sizes and bits allow the threshold."""
    n = bands_for(percent) * ROWS
    sizes = 100 * F.least(f"{a}.n_shingles", f"{b}.n_shingles") >= percent * F.greatest(f"{a}.n_shingles", f"{b}.n_shingles")
    return sizes & (estimated(F.col(f"{a}.bits"), F.col(f"{b}.bits"), n) >= least_estimate(n, percent))


def _first_shared(a: str, b: str) -> Column:
    """The first band key that two members have in common."""
    same = F.zip_with(f"{a}.bands", f"{b}.bands", lambda x, y: F.when(x == y, x))
    return F.get(F.filter(same, lambda key: key.isNotNull()), F.lit(0))


def _sharp(named: DataFrame, docs: DataFrame) -> DataFrame:
    """doc and packed bits of ``SHARP`` minima for the named documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [packed_bits(minima(shingle_hashes(t.as_py() or ""), SHARP)).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.list_(pa.int64()))], names=["doc", "sharp"])

    return _texts_of(named, docs).mapInArrow(run, "doc long, sharp array<long>")


def _texts_of(named: DataFrame, docs: DataFrame) -> DataFrame:
    """doc and text of the documents of a checkpointed list of ids: broadcast when measured small."""
    return docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(broadcast_within(named), "doc").distinct()


def _shingles(text: str) -> set[tuple[bytes, ...]]:
    words = text.encode().lower().split()
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(SHINGLE)]))


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a checkpointed table whose full sets reach the threshold.

    Only texts named in a pair are carried: they are picked by a list of ids that is broadcast when
    measured small and joined by a shuffle otherwise.
    """
    named = cut_lineage(pairs.select("a").union(pairs.select("b")).distinct().toDF("doc"))
    texts = cut_lineage(_texts_of(named, docs))
    first, second = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    joined = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, set()
        for batch in batches:
            linked = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                x = x.as_py() or ""
                if (a, x) != last:
                    last, left = (a, x), _shingles(x)
                right = _shingles(y.as_py() or "")
                both = len(left & right)
                linked.append(both > 0 and 100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long").distinct()


def _with_shared_shingles(named: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The documents of ``named`` (doc, n_shingles) that can have a link among each other.

    A shingle that only one of them has is in no intersection, so a document whose other shingles are
    too few for the threshold has no link; this bound loses none.
    """
    texts = _texts_of(named.select("doc"), docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t.as_py() or "") for t in batch.column(1)]
            owners = np.repeat(np.array(batch.column(0).to_pylist(), np.int64), [len(s) for s in sets])
            shingles, first, counts = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shingles.view(np.int64)), pa.array(owners[first]), pa.array(np.minimum(counts, 2))], names=["shingle", "doc", "n"])

    held = texts.mapInArrow(run, "shingle long, doc long, n long").groupBy("shingle").agg(F.sum("n").alias("n"), F.min("doc").alias("doc"))
    alone = held.where("n = 1").groupBy("doc").agg(F.count("*").alias("alone"))
    left = F.col("n_shingles") - F.coalesce("alone", F.lit(0))
    return named.join(alone, "doc", "left").where(100 * left >= percent * F.col("n_shingles")).select("doc")


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept, for every row of ``docs``."""
    marked = cut_lineage(signatures(docs, percent))
    usable = marked.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(usable.groupBy("set_key").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("bits").alias("bits")))
    in_bands = classes.select("doc", F.explode("bands").alias("bucket"))
    shared = in_bands.groupBy("bucket").agg(F.min("doc").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = cut_lineage(in_bands.join(shared, "bucket"))
    traits = classes.select("doc", F.struct("n_shingles", "bits").alias("of"))

    stars = members.where("doc > pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    left = stars.join(traits.select(F.col("doc").alias("a"), F.col("of").alias("x")), "a")
    both = left.join(traits.select(F.col("doc").alias("b"), F.col("of").alias("y")), "b")
    tested = cut_lineage(both.where(_possible("x", "y", percent)).select("a", "b"))
    links = cut_lineage(_confirmed(tested, docs, percent))
    joined = components(links)

    grouped = members.join(joined, F.col("doc") == F.col("node"), "left").select(
        "bucket", "doc", F.coalesce("component", "doc").alias("group"))
    split = grouped.groupBy("bucket").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least < most")
    open_members = cut_lineage(grouped.join(split.select("bucket"), "bucket"))
    named = cut_lineage(open_members.select("doc").distinct().join(classes.select("doc", "n_shingles"), "doc"))
    possible = cut_lineage(_with_shared_shingles(named, docs, percent))
    described = cut_lineage(classes.select("doc", "n_shingles", "bits", "bands").join(_sharp(possible, docs), "doc"))
    side = open_members.join(described, "doc")
    x, y = side.alias("x"), side.alias("y")
    across = x.join(
        y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.group") < F.col("y.group"))
        & (_first_shared("x", "y") == F.col("x.bucket")) & _possible("x", "y", percent)
        & (estimated(F.col("x.sharp"), F.col("y.sharp"), SHARP) >= least_estimate(SHARP, percent)))
    rest = across.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()
    more = cut_lineage(_confirmed(cut_lineage(rest.join(tested, ["a", "b"], "left_anti")), docs, percent))
    if not more.isEmpty():
        # The components found stand for their links.
        joined = components(joined.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more))

    class_of = classes.select("set_key", "doc").join(joined, F.col("doc") == F.col("node"), "left").select(
        "set_key", F.coalesce("component", "doc").alias("component_id"))
    resolved = marked.select("doc_id", "text_key", "n_shingles", "set_key").join(class_of, "set_key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return resolved.select("doc_id", "text_key", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for every row of ``docs``.

    Runs several jobs when called; each intermediate table is checkpointed to the shared folder.
    """
    return _judged(docs, percent).drop("text_key")


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group of at least ``percent`` similarity."""
    stays = _judged(docs, percent).where("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    keyed = docs.where("doc_id IS NOT NULL").withColumn("_key", _text_key())
    rows = keyed.join(stays, (keyed["doc_id"].cast("long") == stays["kept_id"]) & (keyed["_key"] == stays["kept_key"]), "left_semi")
    others = [c for c in docs.columns if c != "doc_id"]
    one = rows.groupBy("doc_id", "_key").agg(F.min(F.struct(*others)).alias("_row"))
    return one.select("doc_id", "_row.*").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
