"""A deterministic automaton over the tokens of a byte-pair encoding.

Its paths are exactly the token sequences that the merges make of some word.  It starts as one state
with an arc to itself for every symbol.  Each merge (u, v) then adds one gadget, in the order of the merges:
the state that u leads to is set apart for u and loses its arc v, and every state with an arc u gets an
arc uv, which leads to where v led.  All arcs of one token lead to one state, so the automaton is two
tables: the state behind each token, and a bit for each pair of state and token.  Tokens with the same bits
share a row (a group), tokens that lead to the same state share that state.

A word has one path only, and so has each of its starts: encoding goes through the word once, follows
the arcs whose symbols come next, and reads the path backwards from the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

# Symbols are bytes and, where the vocabulary marks ends of words, one more symbol for the end.
END = 256
_SYMBOLS = 257


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


@dataclass(frozen=True)
class Automaton:
    """Tables of the automaton; plain values only, so that it can be sent to executors as they are."""

    spelling: Sequence[bytes]  # symbols of each token, two bytes per symbol
    target: np.ndarray  # state behind each token, -1 behind tokens that end a word
    group: np.ndarray  # row of ``arcs`` of each token
    arcs: np.ndarray  # bit s of a row: state s has these arcs
    n_states: int
    _walk: list = field(default_factory=list, repr=False, compare=False)

    def _root(self) -> dict:
        """The arcs by their symbols: symbol to (next symbols, bits of the token spelt so far, token, state behind)."""
        if not self._walk:
            root: dict[int, list] = {}
            rows, group, target = [row.tobytes() for row in self.arcs], self.group.tolist(), self.target.tolist()
            for token, spelt in enumerate(self.spelling):
                below, entry = root, None
                for symbol in np.frombuffer(spelt, np.uint16).tolist():
                    entry = below.setdefault(symbol, [{}, None, -1, -1])
                    below = entry[0]
                if entry:
                    entry[1:] = rows[group[token]], token, target[token]
            self._walk.append(root)
        return self._walk[0]

    def encode(self, word: bytes, ends: bool = True) -> list[int]:
        """Tokens of a word; ``ends`` puts the end symbol behind its bytes."""
        root = self._root()
        symbols = [*word, END] if ends else list(word)
        n = len(symbols)
        state, arc, came = [0] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            at, bit, below = state[i] >> 3, 1 << (state[i] & 7), root
            for k in range(i, n):
                entry = below.get(symbols[k])
                if entry is None:
                    break
                below, row, token, behind = entry
                if row is not None and row[at] & bit:
                    state[k + 1], arc[k + 1], came[k + 1] = behind, token, i
            if arc[n] >= 0:
                break
        tokens = []
        while n:
            tokens.append(arc[n])
            n = came[n]
        return tokens[::-1]


def compile_merges(vocabulary: dict[str, int], merges: Sequence[Sequence[str]], end: str | None) -> Automaton:
    """The automaton of a list of merges; ``end`` is the text that marks the end of a word in tokens.

    Every merge must build a new token from tokens that exist, as trained vocabularies do; anything else
    is an error.  Tokens that no merge builds are single symbols.
    """
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    built = {left + right for left, right in merges}
    if len(built) != len(merges):
        raise ValueError("two merges build the same token")
    spelling: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
    final = np.zeros(len(spelling), bool)
    for text, token in vocabulary.items():
        bare = text.removesuffix(end) if end else text
        final[token] = bare != text
        symbols = [byte_of[c] for c in bare] + [END] * bool(final[token])
        spelling[token] = np.array(symbols, np.uint16).tobytes()
    base = [token for text, token in vocabulary.items() if text not in built]
    if {spelling[t] for t in base} != {np.array([b] + [END] * e, np.uint16).tobytes() for b in range(256) for e in range(1 + bool(end))}:
        raise ValueError("the vocabulary does not hold each byte, and each byte at the end of a word, as one token")

    # More rows than tokens or states can't arise: each merge adds at most one of each.
    width = (len(merges) + 1) // 8 + 1
    arcs = np.zeros((64, 64), np.uint8)
    arcs[0, 0] = 1
    target, group = np.full(len(spelling), -1, np.int32), np.full(len(spelling), -1, np.int32)
    target[[t for t in base if not final[t]]] = 0
    group[base] = 0
    # Who leads to a state (the start itself counts) and which tokens share a group.
    # Group 1 is that of tokens which no state has: their merge is always preceded by another.
    leading, sharing = [1 + int((target == 0).sum())], [len(base), 1]
    for left, right in merges:
        u, v, w = vocabulary[left], vocabulary[right], vocabulary[left + right]
        if group[u] < 0 or group[v] < 0 or group[w] >= 0 or final[u]:
            raise ValueError(f"merge of {left!r} and {right!r} is out of order")
        before = int(target[u])
        if not arcs[group[v], before >> 3] >> (before & 7) & 1:
            group[w] = 1
            sharing[1] += 1
            continue
        target[w] = target[v]
        if target[w] >= 0:
            leading[target[w]] += 1
        if leading[before] > 1:
            own = len(leading)
            leading[before] -= 1
            leading.append(1)
            if own >= 8 * arcs.shape[1]:
                arcs = np.pad(arcs, ((0, 0), (0, min(arcs.shape[1], width))))
            used = arcs[:len(sharing)]
            used[:, own >> 3] |= (used[:, before >> 3] >> np.uint8(before & 7) & np.uint8(1)) << np.uint8(own & 7)
            target[u] = own
        own = int(target[u])
        if sharing[group[v]] > 1:
            sharing[group[v]] -= 1
            if len(sharing) == len(arcs):
                arcs = np.pad(arcs, ((0, len(arcs)), (0, 0)))
            arcs[len(sharing)] = arcs[group[v]]
            group[v] = len(sharing)
            sharing.append(1)
        arcs[group[v], own >> 3] &= np.uint8(255 ^ (1 << (own & 7)))
        group[w] = group[u]
        sharing[group[u]] += 1
    n_states = len(leading)
    return Automaton(spelling, target, group, np.ascontiguousarray(arcs[:len(sharing), :(n_states + 7) // 8]), n_states)
