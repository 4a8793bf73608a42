"""A linear-chain conditional random field that labels the words of code-switched text.

A word's features are its affixes, its byte n-grams and its entry in a lexicon of frequent
words, hashed into one table of weights; neighbouring words are tied by learned transitions.
Features are computed on whole arrays of bytes, and forward-backward runs over many lines at
once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from uptake.llm.decontamination import _hashed, _lower
from uptake.llm.shingles import mix

FEATURE_BITS = 15
LEXICON_WORDS = 1 << 14
LEXICON_DOCUMENTS = 3
ROUNDS = 25
RATE = 0.2
PENALTY = 1e-6
SPLICED_WORDS = 12  # mean length of a part of a spliced training line

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_PLACES = np.array([pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64) for i in range(4)], np.uint64)


@dataclass(frozen=True)
class Words:
    """Words of some texts: byte ranges, hashes, and the line each one is in."""

    data: np.ndarray  # lower-cased bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    line: np.ndarray  # from 0, without gaps, no line reaching over two texts
    first: np.ndarray  # first word of each text


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of letters of texts that each end in a line feed."""
    inside = _LETTER[data]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    lower, _ = _lower(data)
    feeds = np.cumsum(data == ord("\n"), dtype=np.int32)
    line = np.unique(feeds[starts], return_inverse=True)[1] if len(starts) else starts
    return Words(
        lower, starts, ends, _hashed(lower, starts, ends), line, np.searchsorted(starts, offsets)
    )


def features(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the chosen words and where those of each word start."""
    starts, lengths = words.starts[chosen], (words.ends - words.starts)[chosen]
    count = len(chosen)
    groups, owners = [], []

    def add(owner: np.ndarray, hashes: np.ndarray, kind: int) -> None:
        mixed = mix(hashes + np.uint64(kind))
        groups.append((mixed & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int32))
        owners.append(owner)

    def rolled(at: np.ndarray, n: int) -> np.ndarray:
        total = np.zeros(len(at), np.uint64)
        for i in range(n):
            total += (words.data[at + i].astype(np.uint64) + np.uint64(1)) * _PLACES[i]
        return total

    every = np.arange(count)
    add(every, np.zeros(count, np.uint64), 1)
    for n in (1, 2, 3, 4):
        own = np.flatnonzero(lengths >= n)
        add(own, rolled(starts[own], n), 10 + n)
        add(own, rolled(starts[own] + lengths[own] - n, n), 20 + n)
    for n in (2, 3):
        pieces = np.maximum(lengths - n + 1, 0)
        owner = np.repeat(every, pieces)
        place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        add(owner, rolled(starts[owner] + place, n), 30 + n)
    owner, numbers = np.concatenate(owners), np.concatenate(groups)
    order = np.argsort(owner, kind="stable")
    return numbers[order], np.searchsorted(owner[order], every)


def posteriors(
    scores: np.ndarray, line: np.ndarray, moves: np.ndarray, begin: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None, float]:
    """Forward-backward: label probabilities of every word, expected numbers of moves between
    labels (if asked for), and the sum of the lines' log partition functions."""
    n, k = scores.shape
    top = scores.max(1, keepdims=True)
    local = np.exp(scores - top)
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    length = np.diff(np.r_[first, n])
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    step = np.exp(moves)
    ahead, scale = np.empty((n, k)), np.empty(n)
    live = len(first)
    state = local[first] * np.exp(begin)
    for t in range(int(length[0])):
        while live and length[live - 1] <= t:
            live -= 1
        at = first[:live] + t
        if t:
            state = (state[:live] @ step) * local[at]
        total = state.sum(1)
        state = state / total[:, None]
        ahead[at], scale[at] = state, total
    behind = np.ones((len(first), k))
    out = np.empty((n, k))
    expected = np.zeros((k, k)) if pairs else None
    lives = np.searchsorted(-length, -np.arange(int(length[0])), "left")
    for t in range(int(length[0]) - 1, -1, -1):
        at = first[: lives[t]] + t
        out[at] = ahead[at] * behind[: lives[t]]
        if t:
            right = behind[: lives[t]] * local[at] / scale[at, None]
            if pairs:
                expected += step * (ahead[at - 1].T @ right)
            behind[: lives[t]] = right @ step.T
    return out, expected, float(np.log(scale).sum() + top.sum())


@dataclass(frozen=True)
class Model:
    labels: list[str]
    weights: np.ndarray  # of hashed features, then of the lexicon's words
    lexicon: np.ndarray  # sorted word hashes
    moves: np.ndarray
    begin: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Label scores of every word; each different word is looked at once."""
        _, chosen, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        numbers, place = features(words, chosen)
        own = np.add.reduceat(self.weights[numbers], place, axis=0)
        entry, known = _lookup(self.lexicon, words.hashes[chosen])
        own[known] += self.weights[(1 << FEATURE_BITS) + entry[known]]
        return own[inverse]

    def label(self, words: Words) -> np.ndarray:
        """Label probabilities of every word."""
        if not len(words.starts):
            return np.empty((0, len(self.labels)))
        return posteriors(self.scores(words), words.line, self.moves, self.begin)[0]


def _lookup(lexicon: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(lexicon):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    entry = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return entry, lexicon[entry] == hashes


def _spliced(words: Words, label: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Places and lines of code-switched training lines, spliced from parts of natural ones."""
    n = len(words.starts)
    parts = max(1, n // SPLICED_WORDS)
    begin = rng.integers(0, n, parts)
    length = 1 + rng.poisson(SPLICED_WORDS - 1, parts)
    stop = np.minimum(begin + length, np.searchsorted(words.line, words.line[begin], "right"))
    size = stop - begin
    place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    line = np.repeat(np.cumsum(rng.random(parts) < 1 / 3), size)
    return place, line


def train(data: np.ndarray, offsets: np.ndarray, langs: list[str], rounds: int = ROUNDS) -> Model:
    """Fit the field on labelled texts by gradient ascent with adaptive steps.

    All words of a text have its label. Lines spliced from texts of several languages stand
    beside the natural lines, so transitions between languages are learned.
    """
    labels = sorted(set(langs))
    k = len(labels)
    words = split_words(data, offsets)
    if not len(words.starts) or not k:
        zeros = np.zeros((k, k))
        table = np.zeros((1 << FEATURE_BITS, k))
        return Model(labels, table, np.empty(0, np.uint64), zeros, np.zeros(k))
    text = np.searchsorted(words.first, np.arange(len(words.starts)), "right") - 1
    truth = np.searchsorted(labels, langs)[text]
    seen = np.unique(np.stack([words.hashes, text.astype(np.uint64)]), axis=1)[0]
    names, documents = np.unique(seen, return_counts=True)
    names = names[np.argsort(-documents, kind="stable")][: (documents >= LEXICON_DOCUMENTS).sum()]
    lexicon = np.sort(names[:LEXICON_WORDS])

    _, chosen, word = np.unique(words.hashes, return_index=True, return_inverse=True)
    numbers, place = features(words, chosen)
    entry, known = _lookup(lexicon, words.hashes[chosen])
    sizes = np.diff(np.r_[place, len(numbers)])
    owner = np.repeat(np.arange(len(chosen)), sizes)
    spliced, spliced_line = _spliced(words, truth, np.random.default_rng(0))
    token = np.r_[np.arange(len(words.starts)), spliced]
    line = np.r_[words.line, words.line[-1] + 1 + spliced_line]
    word, truth = word[token], truth[token]
    opens = np.r_[True, line[1:] != line[:-1]]
    moved = np.zeros((k, k))
    inner = np.flatnonzero(~opens)
    np.add.at(moved, (truth[inner - 1], truth[inner]), 1)
    started = np.bincount(truth[opens], minlength=k).astype(float)

    size = 1 << FEATURE_BITS
    # Weights of features, of the lexicon, of moves and of starts, in one vector.
    cuts = np.cumsum([size * k, len(lexicon) * k, k * k])
    vector = np.zeros(cuts[-1] + k)
    first, second = np.zeros_like(vector), np.zeros_like(vector)
    for i in range(1, rounds + 1):
        table, lex, moves, begin = np.split(vector, cuts)
        table, lex, moves = table.reshape(size, k), lex.reshape(-1, k), moves.reshape(k, k)
        own = np.add.reduceat(table[numbers], place, axis=0)
        own[known] += lex[entry[known]]
        found, pairs, _ = posteriors(own[word], line, moves, begin, pairs=True)
        error = -found
        error[np.arange(len(truth)), truth] += 1
        by_word = np.stack([np.bincount(word, error[:, j], len(chosen)) for j in range(k)], 1)
        gradient = np.concatenate(
            [
                np.stack([np.bincount(numbers, by_word[owner, j], size) for j in range(k)], 1).ravel(),
                np.stack(
                    [np.bincount(entry[known], by_word[known, j], len(lexicon)) for j in range(k)], 1
                ).ravel(),
                (moved - pairs).ravel(),
                started - found[opens].sum(0),
            ]
        ) / len(truth) - PENALTY * vector
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        vector = vector + RATE * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
    table, lex, moves, begin = np.split(vector, cuts)
    weights = np.concatenate([table.reshape(size, k), lex.reshape(-1, k)])
    return Model(labels, weights, lexicon, moves.reshape(k, k), begin)
