"""Quality rules: statistics of a text, and a decision list learned from labelled statistics.

``learn`` grows a list of rules by sequential covering.  A rule is a conjunction of thresholds that
rejects documents: conditions are added by the greatest information gain on two thirds of the labelled
rows, pruned from the end on the other third, and the rule is kept when its precision there is high.
What it covers is set aside and the next rule is grown.  The list is applied as one ordered
conditional expression, so scoring is a plain projection.

Learning reads a bounded sample: at most ``LEARN_ROWS`` labelled documents in the order of a hash.  Each
step of growing is one aggregation over the binned sample and returns one row per threshold.

Defined cases: a null or empty text has no words and all statistics 0 (it fails the base rules);
rows that repeat are judged each for itself; without usable labels the list is empty and rejects
nothing beyond the base rules; columns of the input named like a statistic are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from statcube.llm.common import SPACE_CHARS, char_count, count_of, text_of, words_of
from statcube.session import cut_lineage

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"

LEARN_ROWS = 10_000
BINS = 24
MAX_RULES = 12
MAX_CONDITIONS = 3
MIN_COVERED = 8
MIN_PRECISION = 0.8

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered_words(starts: Column, width: int) -> Column:
    """Words under windows of ``width`` words at ascending starts: each adds what its successor leaves."""
    gaps = F.transform(starts, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - p, F.lit(width))))
    return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)


def with_statistics(docs: DataFrame) -> DataFrame:
    """Adds the base statistics and the shares that the rules are learned from.

    Repeated windows are found inside the row: equal hashes of windows are neighbours once sorted, and
    only texts in which a hash occurs twice are sorted at all.
    """
    added = [*BASE, *FEATURES]
    row = F.struct(*[c for c in docs.columns if c not in added]).alias("row")
    text = text_of()
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(SPACE_CHARS)) != "")
    first = docs.select(
        row, F.transform(words_of(text), lambda w: F.xxhash64(w)).alias("h"), lines.alias("lines"),
        (F.length(text) - count_of(text, SPACE_CHARS)).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).cast("long").alias("n_symbols"), count_of(text, "!?").alias("n_loud"),
        char_count(text, r"\p{Lu}+").alias("n_upper"))
    n = F.size("h")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    second = first.select("*", F.transform(starts, lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])).alias("g"))
    third = second.withColumn("repeats", F.size(F.array_distinct("g")) < F.size("g")).withColumn(
        "sorted", F.when(F.col("repeats"), F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    pair = F.filter(F.transform("sorted", lambda s, i: F.when(
        (F.get("sorted", i - 1)["x"] == s["x"]) | (F.get("sorted", i + 1)["x"] == s["x"]), s["i"])), lambda i: i.isNotNull())
    fourth = third.withColumn("twice", F.when(F.col("repeats"), F.sort_array(pair)))
    repeated = F.when(F.col("repeats"), _covered_words(F.col("twice"), WINDOW)).otherwise(0)
    # One row per row through a generator: a later filter on these columns stays above it, instead of
    # being pushed below the steps and computing them once more for each time they are named.
    counted = fourth.select("row", F.inline(F.array(F.struct(
        n.cast("long").alias("n_words"), F.col("word_chars"),
        F.col("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"), F.col("n_upper"), F.col("n_loud"),
        F.size("lines").alias("n_lines")))))
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    shares = {
        "mean_word": F.col("word_chars") / words, "symbol_share": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words, "upper_share": F.col("n_upper") / chars,
        "loud_share": F.col("n_loud") / words,
        "line_words": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
        "length": F.col("n_words").cast("double"),
    }
    return counted.select("row.*", *BASE, *[shares[f].alias(f) for f in FEATURES])


FEATURES = (
    "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "loud_share",
    "line_words", "length",
)


def base_failed() -> Column:
    """Too short, or more than a fifth of the words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def matches(rule: Rule) -> Column:
    held = F.lit(True)
    for condition in rule:
        held = held & condition.column()
    return held


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1 on; 0 when none rejects the document."""
    decided = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, 1))):
        decided = F.when(matches(rule), F.lit(number)).otherwise(decided)
    return decided


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> DataFrame:
    """Statistics of at most ``rows`` labelled documents with ``bad`` and ``prune`` flags; checkpointed.

    The sample of ids is cut before texts are read, and only that bounded list is broadcast.
    """
    voted = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = voted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    flags = with_statistics(chosen).where(~base_failed()).select(
        *FEATURES, (F.col("quality") == 0).alias("bad"), (F.xxhash64("doc_id", F.lit("prune")) % 3 == 0).alias("prune"))
    return cut_lineage(flags)


def _thresholds(sample: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds: midway between neighbours among the quantiles of both classes."""
    cuts = [i / BINS for i in range(BINS + 1)]
    found: dict[str, set[float]] = {f: set() for f in FEATURES}
    for row in sample.groupBy("bad").agg(*[F.percentile_approx(f, cuts, 10_000).alias(f) for f in FEATURES]).collect():
        for f in FEATURES:
            found[f].update(row[f] or [])
    ordered = {f: sorted(v) for f, v in found.items()}
    return {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in ordered.items()}


def _cuts_below(value: Column, cuts: list[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: value > t))


def _counts(sample: DataFrame, grid: dict[str, list[float]], covered: Column) -> dict[tuple[str, int], tuple[int, int]]:
    """Bad and good rows per feature and bin, for the rows a partial rule covers: one job."""
    binned = [
        F.struct(F.lit(f).alias("feature"), _cuts_below(F.col(f), grid[f]).alias("bin")) for f in FEATURES if grid[f]
    ]
    if not binned:
        return {}
    rows = sample.where(covered).select("bad", F.explode(F.array(*binned)).alias("b")).groupBy("b.feature", "b.bin").agg(
        F.sum(F.col("bad").cast("int")).alias("bad"), F.sum((~F.col("bad")).cast("int")).alias("good")).collect()
    return {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in rows}


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    if not bad:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(bad_before / (bad_before + good_before)))


def _best_condition(counts: dict[tuple[str, int], tuple[int, int]], grid: dict[str, list[float]]) -> tuple[float, Condition | None, int, int]:
    best: tuple[float, Condition | None, int, int] = (0.0, None, 0, 0)
    for f in FEATURES:
        bins = [counts.get((f, b), (0, 0)) for b in range(len(grid[f]) + 1)]
        bad_all, good_all = sum(b for b, _ in bins), sum(g for _, g in bins)
        bad_low = good_low = 0
        for i, threshold in enumerate(grid[f]):
            bad_low, good_low = bad_low + bins[i][0], good_low + bins[i][1]
            for above, bad, good in ((True, bad_all - bad_low, good_all - good_low), (False, bad_low, good_low)):
                gain = _gain(bad, good, bad_all, good_all) if bad >= MIN_COVERED else 0.0
                if gain > best[0] + 1e-9:
                    best = (gain, Condition(f, above, threshold), bad, good)
    return best


def _grow(sample: DataFrame, grid: dict[str, list[float]], left: Column) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        counts = _counts(sample, grid, left & matches(rule) & ~F.col("prune"))
        gain, condition, _, good = _best_condition(counts, grid)
        if condition is None:
            break
        rule = (*rule, condition)
        if good == 0:
            break
    return rule


def _prune(sample: DataFrame, rule: Rule, left: Column) -> tuple[Rule, int, int]:
    """The prefix of the rule that is best on the pruning rows, with its bad and good rows there."""
    sums = []
    for k in range(1, len(rule) + 1):
        held = left & F.col("prune") & matches(rule[:k])
        sums += [F.coalesce(F.sum((held & F.col("bad")).cast("int")), F.lit(0)), F.coalesce(F.sum((held & ~F.col("bad")).cast("int")), F.lit(0))]
    row = sample.agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)]).first()
    scored = [((row[2 * k] - row[2 * k + 1]) / max(1, row[2 * k] + row[2 * k + 1]), k) for k in range(len(rule))]
    _, k = max(scored, key=lambda s: (s[0], -s[1]))
    return rule[: k + 1], row[2 * k], row[2 * k + 1]


def learn(sample: DataFrame) -> list[Rule]:
    """An ordered list of rejecting rules; empty when no rule proves precise."""
    grid, rules, left = _thresholds(sample), [], F.lit(True)
    while len(rules) < MAX_RULES:
        rule = _grow(sample, grid, left)
        if not rule:
            break
        rule, bad, good = _prune(sample, rule, left)
        if bad < MIN_PRECISION * (bad + good) or bad == 0:
            break
        rules.append(rule)
        left = left & ~matches(rule)
    return rules


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds the statistics, ``base_failed``, ``rule`` (0: none) and ``kept``."""
    judged = with_statistics(docs.drop("base_failed", "rule", "kept")).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
