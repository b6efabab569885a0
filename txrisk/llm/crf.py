"""A linear-chain conditional random field over the words of a text, with numpy on batches of chains."""

from __future__ import annotations

import re
from dataclasses import dataclass
from collections import Counter

import numpy as np

#: A word (letters only), or an end of a sentence. Longer runs of letters, as in scripts without blanks, are several words of a chain.
TOKENS = re.compile(r"[^\W\d_]{1,64}|[.!?\n]")
ENDS = frozenset(".!?\n")
#: Texts are read in pieces of about so many characters, so that a very long one needs no more memory.
PIECE = 1 << 20
#: Most different words whose scores a task keeps.
CACHE = 1 << 18


def pieces(text: str, size: int = PIECE):
    """The text in order, cut after a blank where there is one in a piece, else at ``size``."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        if end < len(text):
            end = max(text.rfind(" ", at, end), text.rfind("\n", at, end)) + 1 or end
        yield text[at:end]
        at = end


def features(word: str) -> list[str]:
    """Lexicon entry, affixes of 1 to 4 letters and inner 3-grams of a lower-case word."""
    marked = f"^{word}$"
    out = ["", f"={word}", marked[:2], marked[:3], marked[:4], marked[:5], marked[-2:], marked[-3:], marked[-4:], marked[-5:]]
    out += [word[i : i + 3] for i in range(len(word) - 2)]
    return out


def lay(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of chains from long to short, their first words, and for each step how many chains reach it."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    reach = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")
    return order, starts, reach


def forward_backward(
    emission: np.ndarray, lengths: np.ndarray, first: np.ndarray, switch: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None, float]:
    """Label probabilities of every word; sums of neighbours' label pairs; log-likelihood's normaliser.

    ``emission`` (words x labels), ``first`` and ``switch`` hold factors, not logarithms. The words of the chains, of the
    given lengths, follow each other. All chains take a step at once, and every step is scaled.
    """
    _, starts, reach = lay(lengths)
    alpha, log_z, carried = np.empty_like(emission), 0.0, None
    for t, n in enumerate(reach):
        at = starts[:n] + t
        now = emission[at] * (first if carried is None else carried[:n] @ switch)
        scale = now.sum(1, keepdims=True)
        carried = now / scale
        alpha[at] = carried
        log_z += float(np.log(scale).sum())
    gamma, seen = alpha.copy(), np.zeros_like(switch) if pairs else None
    for t in range(len(reach) - 2, -1, -1):
        n = reach[t + 1]
        here, after = starts[:n] + t, starts[:n] + t + 1
        # alpha * beta after, over alpha after, is beta after up to its scale
        ahead = emission[after] * (gamma[after] / np.maximum(alpha[after], 1e-300))
        both = alpha[here] * (ahead @ switch.T)
        norm = both.sum(1, keepdims=True)
        gamma[here] = both / norm
        if seen is not None:
            seen += switch * ((alpha[here] / norm).T @ ahead)
    return gamma, seen, log_z


@dataclass
class Model:
    labels: list[str]
    rows: dict[str, int]  # of features
    weights: np.ndarray  # features x labels
    first: np.ndarray
    switch: np.ndarray

    def factors(self, words: list[str]) -> np.ndarray:
        """Emission factors of lower-case words, the largest of each being 1."""
        rows, bias = self.rows, self.rows[""]
        of = [[i for f in features(w) if (i := rows.get(f)) is not None] or [bias] for w in words]
        begins = np.cumsum([0, *map(len, of[:-1])])
        total = np.add.reduceat(self.weights[np.fromiter((i for x in of for i in x), np.int64)], begins).astype(float)
        return np.exp(np.clip(total - total.max(1, keepdims=True), -30, 0))


def train(chains: list[tuple[list[str], list[int]]], labels: list[str], rounds: int = 80, decay: float = 2e-4) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam on all chains at once.

    ``chains`` holds lower-case words and the index of each word's label. Features and lexicon entries seen in fewer than
    two different words, or twice for the lexicon, are left out.
    """
    k = len(labels)
    counts = Counter(w for words, _ in chains for w in words)
    types = {w: i for i, w in enumerate(counts)}
    seen = Counter(f for w in types for f in features(w) if f[:1] != "=")
    seen.update({f"={w}": n for w, n in counts.items()})
    index = {f: i for i, f in enumerate(["", *(f for f, n in seen.items() if n > 1 and f)])}
    of = [[index[f] for f in features(w) if f in index] for w in types]
    flat, ends = np.fromiter((i for x in of for i in x), np.int64), np.cumsum([len(x) for x in of])
    begins, owner = ends - [len(x) for x in of], np.repeat(np.arange(len(of)), [len(x) for x in of])
    ids = np.fromiter((types[w] for words, _ in chains for w in words), np.int64)
    gold = np.fromiter((y for _, ys in chains for y in ys), np.int64)
    lengths = np.array([len(words) for words, _ in chains], np.int64)
    starts = np.cumsum(lengths) - lengths
    truth_first = np.bincount(gold[starts], minlength=k).astype(float)
    inner = np.ones(len(gold) - 1, bool)
    inner[starts[1:] - 1] = False
    truth_pairs = np.zeros((k, k))
    np.add.at(truth_pairs, (gold[:-1][inner], gold[1:][inner]), 1)
    truth_words = np.zeros((len(types), k))
    np.add.at(truth_words, (ids, gold), 1)
    shapes = [(len(index), k), (k,), (k, k)]
    params = [np.zeros(s) for s in shapes]
    first_moment, second_moment = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for step in range(1, rounds + 1):
        w, first, switch = params
        logits = np.add.reduceat(w[flat], begins)
        factors = np.exp(np.clip(logits - logits.max(1, keepdims=True), -30, 0))
        gamma, pairs, _ = forward_backward(factors[ids], lengths, np.exp(first), np.exp(switch), pairs=True)
        of_words = np.stack([np.bincount(ids, gamma[:, y], len(types)) for y in range(k)], 1) - truth_words
        of_features = np.stack([np.bincount(flat, of_words[owner, y], len(index)) for y in range(k)], 1)
        grads = [of_features, gamma[starts].sum(0) - truth_first, pairs - truth_pairs]
        for p, g, m, v in zip(params, grads, first_moment, second_moment):
            g = g / len(ids) + decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    w, first, switch = params
    return Model(labels, index, w.astype(np.float32), np.exp(first), np.exp(switch))


class Labeller:
    """Sums the label probabilities of the words of texts, chains of many texts at a time."""

    def __init__(self, model: Model, chain_words: int = 48, block_words: int = 100_000):
        self.model, self.chain_words, self.block_words = model, chain_words, block_words
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[str, int] = dict.fromkeys(ENDS, 0)
        self.table, self.rows = np.ones((4096, len(self.model.labels))), 1

    def _learn(self, tokens: set[str]) -> None:
        """Give new tokens a row: that of their lower-case form, 0 if none of their characters is a letter."""
        fresh: dict[str, int] = {}
        for token in tokens:
            if token.isalpha() or any(map(str.isalpha, token)):
                lower = token.lower()
                at = self.ids.get(lower) or fresh.setdefault(lower, self.rows + len(fresh))
                self.ids[token] = at
            else:
                self.ids[token] = 0
        if fresh:
            self.ids.update(fresh)
            end = self.rows + len(fresh)
            if end > len(self.table):
                self.table = np.vstack([self.table, np.ones((max(end, len(self.table)), self.table.shape[1]))])
            self.table[self.rows : end] = self.model.factors(list(fresh))
            self.rows = end

    def sums(self, texts: list[str | None]) -> np.ndarray:
        """For every text the sum of its words' label probabilities; all zero if it has no letter."""
        out = np.zeros((len(texts), len(self.model.labels)))
        held: list[np.ndarray] = []
        owners: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            for piece in pieces(text) if text else ():
                if len(self.ids) > CACHE:
                    self._flush(held, owners, out)
                    held, owners, size = [], [], 0
                    self._reset()
                known, tokens = self.ids, TOKENS.findall(piece)
                if fresh := {t for t in tokens if t not in known}:
                    self._learn(fresh)
                ids = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
                held.append(np.append(ids, 0))  # a piece ends a chain
                owners.append(i)
                size += len(ids)
                if size >= self.block_words:
                    self._flush(held, owners, out)
                    held, owners, size = [], [], 0
        self._flush(held, owners, out)
        return out

    def _flush(self, held: list[np.ndarray], owners: list[int], out: np.ndarray) -> None:
        if not held:
            return
        ids, of = np.concatenate(held), np.repeat(owners, [len(x) for x in held])
        word = ids > 0
        before = np.cumsum(~word)[word]  # words with the same number stand in one sentence
        ids, of = ids[word], of[word]
        if not len(ids):
            return
        begins = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        nth = np.arange(len(ids)) - np.repeat(begins, np.diff(np.append(begins, len(ids))))
        begins = np.flatnonzero(nth % self.chain_words == 0)
        gamma, _, _ = forward_backward(self.table[ids], np.diff(np.append(begins, len(ids))), self.model.first, self.model.switch)
        for y in range(out.shape[1]):
            out[:, y] += np.bincount(of, gamma[:, y], len(out))
