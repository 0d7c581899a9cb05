"""Toxicity by weak supervision.

Many voters look at a text: groups of words from a seed lexicon and from words that the labels point to,
and patterns of style.  A generative label model takes each voter's votes, and the given label as one more
voter, as noisy observations of a hidden class.  It estimates their accuracies by expectation
maximisation, and their correlations from what agreement is left once the class is known: a voter that
repeats others counts for less.  The posterior classes train a linear classifier on words, which scores
every document over its whole text.

The models are fitted on a bounded sample (``TRAIN_ROWS`` labelled documents).

Defined cases: a null or empty text has no words and gets the score of the bias; without labels of both
classes all scores are the share of label 1 (0.0 without labels); rows that repeat get equal scores.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from statcube.llm.common import fold
from statcube.llm.learning import labelled_sample, logistic, scored
from statcube.llm.wordhash import mixed, word_hashes

TRAIN_ROWS = 16_000
FOLDS, HELD_FOLD = 5, 0

MINED_VOTERS = 8
MINED_WORDS = 96
MIN_DOCUMENTS = 4
FEATURES = 4096
EM_ROUNDS = 40
RIDGE = 0.005
DESCENTS = 500

# Seed lexicon: one group per voter.
LEXICON = {
    "stupidity": "idiot idiots moron morons stupid dumb imbecile fool brainless cretin dumbass halfwit",
    "contempt": "pathetic worthless useless loser losers disgusting scum trash garbage filth vermin clown freak",
    "hatred": "hate hateful despise bastard bastards parasite parasites subhuman degenerate pig pigs rat rats",
    "threat": "kill die murder destroy hang shoot burn slaughter exterminate",
    "profanity": "damn hell crap shit fuck fucking bitch ass asshole bullshit",
}

_LETTERS = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _LETTERS[_c] = 32
    elif chr(_c).isupper():
        _LETTERS[_c] = _c + 32
_STYLE = 3


def _words(data: bytes) -> np.ndarray:
    """Hashes of the words in lower case, split at everything that is no letter or digit."""
    return word_hashes(_LETTERS[np.frombuffer(data, np.uint8)].tobytes())


def _style_marks() -> np.ndarray:
    return mixed(np.arange(1, _STYLE + 1, dtype=np.uint64))


def indicators(text: str) -> np.ndarray:
    """Distinct word hashes, and marks for style: shouting, exclamation, censored words."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    n = max(1, len(raw))
    upper = ((raw >= 65) & (raw <= 90)).sum() / n
    loud = (raw == 33).sum() / n
    letters = (raw | 32 >= 97) & (raw | 32 <= 122)
    star = raw == 42
    censored = bool((star[1:-1] & letters[:-2] & (star[2:] | letters[2:])).any()) if len(raw) > 2 else False
    marks = _style_marks()[np.array([upper > 0.3, loud > 0.01, censored])]
    return np.unique(np.concatenate([_words(data), marks]))


def presence(rows: list[np.ndarray], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the words of a sorted vocabulary in the rows."""
    lengths = [len(r) for r in rows]
    every = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(rows)), lengths)
    column = np.searchsorted(vocabulary, every).clip(max=max(0, len(vocabulary) - 1))
    hit = vocabulary[column] == every if len(vocabulary) else np.zeros(len(every), bool)
    return row[hit], column[hit]


def vocabulary_of(labels: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Words in enough documents that differ most between the labels, sorted, with their signed chi-square root."""
    words, counts = np.unique(np.concatenate(rows), return_counts=True)
    words = words[counts >= MIN_DOCUMENTS]
    row, column = presence(rows, words)
    both = np.bincount(column, minlength=len(words)).astype(float)
    toxic = np.bincount(column, weights=labels[row], minlength=len(words))
    share = labels.mean()
    strength = (toxic - both * share) / np.sqrt(both * share * (1 - share) * (1 - both / len(rows)) + 1e-9)
    chosen = np.sort(np.argsort(-np.abs(strength), kind="stable")[:FEATURES])
    return words[chosen], strength[chosen]


def votes(labels: np.ndarray, rows: list[np.ndarray], vocabulary: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """One column per voter: 1 where one of its words or marks occurs, else 0."""
    ranked = np.argsort(-strength, kind="stable")[:MINED_WORDS]
    ranked = ranked[strength[ranked] > 0]
    groups = [vocabulary[np.sort(ranked[k::MINED_VOTERS])] for k in range(MINED_VOTERS)]
    groups += [np.unique(_words(words.encode())) for words in LEXICON.values()]
    groups += [np.array([mark]) for mark in _style_marks()]
    ballot = np.zeros((len(rows), len(groups)))
    for k, group in enumerate(groups):
        row, _ = presence(rows, group)
        ballot[row, k] = 1
    return ballot


def label_model(ballot: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the toxic class, rates of a vote in both classes, and the voters' weights.

    Starts from the given labels.  A voter's weight is one over the sum of its absolute conditional
    correlations with all voters, itself included, so copies of a voter share one vote.
    """
    seen = np.column_stack([ballot, labels])
    posterior = np.clip(labels, 0.05, 0.95)
    weight = np.ones(seen.shape[1])
    rates = np.zeros((2, seen.shape[1]))
    for _ in range(EM_ROUNDS):
        prior = posterior.mean()
        for side, p in enumerate((1 - posterior, posterior)):
            rates[side] = (p @ seen + 1.0) / (p.sum() + 2.0)
        left = seen - (np.outer(posterior, rates[1]) + np.outer(1 - posterior, rates[0]))
        spread = np.sqrt((left**2).mean(axis=0)) + 1e-9
        correlation = np.abs((left.T @ left) / len(left) / np.outer(spread, spread))
        np.fill_diagonal(correlation, 1.0)
        correlation[correlation < 0.1] = 0.0
        weight = 1.0 / correlation.sum(axis=1)
        odds = np.log(rates[1] / rates[0]), np.log((1 - rates[1]) / (1 - rates[0]))
        score = seen @ (weight * odds[0]) + (1 - seen) @ (weight * odds[1]) + np.log(prior / (1 - prior))
        posterior = np.clip(logistic(score), 1e-4, 1 - 1e-4)
    return posterior, rates, weight


def linear_classifier(rows: list[np.ndarray], vocabulary: np.ndarray, posterior: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression on soft labels, by accelerated gradient steps."""
    row, column = presence(rows, vocabulary)
    n, width = len(rows), len(vocabulary)
    centre = np.bincount(column, minlength=width) / n
    weights, bias, at, at_bias = np.zeros(width), float(np.log(posterior.mean() / (1 - posterior.mean()))), np.zeros(width), 0.0
    at_bias = bias
    # Words in few documents get larger steps: the curvature of a coordinate is at most a quarter of its share.
    step = 1.0 / (0.25 * np.sqrt(centre) * np.sqrt(np.bincount(row, weights=np.sqrt(centre[column]), minlength=n).max() + 1) + RIDGE / n + 1e-6)
    momentum = 1.0
    for _ in range(DESCENTS):
        margin = np.bincount(row, weights=at[column], minlength=n) + at_bias
        error = logistic(margin) - posterior
        gradient = np.bincount(column, weights=error[row], minlength=width) / n + RIDGE / n * at
        new, new_bias = at - step * gradient, at_bias - 2.0 * error.mean()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        at, at_bias = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias, momentum = new, new_bias, following
    return weights, float(bias)


def fit(labels: np.ndarray, rows: list[np.ndarray]) -> Callable[[str], float]:
    """A scoring function of texts."""
    if not len(labels) or labels.min() == labels.max():
        constant = float(labels.mean()) if len(labels) else 0.0
        return lambda text: constant
    vocabulary, strength = vocabulary_of(labels, rows)
    posterior, _, _ = label_model(votes(labels, rows, vocabulary, strength), labels)
    weights, bias = linear_classifier(rows, vocabulary, posterior)

    def score(text: str) -> float:
        _, column = presence([indicators(text)], vocabulary)
        return float(logistic(weights[column].sum() + bias))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.  Fits the models when called."""
    held = fold(F.col("doc_id"), FOLDS) == HELD_FOLD
    return scored(docs, fit(*labelled_sample(docs, labels, "toxic", ~held, train_rows, indicators)), held)
