"""Chains of words, without Spark: label probabilities against all paths, long words, and words before a place."""

import itertools

import numpy as np
import pytest

from txrisk.llm import pii
from txrisk.llm.crf import TOKENS, features, forward_backward


@pytest.mark.parametrize("labels", [1, 2, 3])
def test_forward_backward_is_the_sum_over_all_paths(labels):
    dice = np.random.default_rng(labels)
    lengths = np.array([1, 4, 2, 4, 3])
    emission = dice.random((lengths.sum(), labels)) + 0.01
    first, switch = dice.random(labels) + 0.01, dice.random((labels, labels)) + 0.01
    gamma, seen, log_z = forward_backward(emission, lengths, first, switch, pairs=True)
    want, pairs, total, at = np.zeros_like(emission), np.zeros_like(switch), 0.0, 0
    for n in lengths:
        here, both, z = np.zeros((n, labels)), np.zeros_like(switch), 0.0
        for path in itertools.product(range(labels), repeat=int(n)):
            weight = first[path[0]] * np.prod([emission[at + t, y] for t, y in enumerate(path)])
            weight *= np.prod([switch[a, b] for a, b in zip(path, path[1:])])
            z += weight
            for t, y in enumerate(path):
                here[t, y] += weight
            for a, b in zip(path, path[1:]):
                both[a, b] += weight
        want[at : at + n] = here / z
        pairs += both / z
        total += np.log(z)
        at += n
    assert np.allclose(gamma, want) and np.allclose(seen, pairs) and np.isclose(log_z, total)


def test_every_letter_of_a_long_word_is_read():
    word = "".join(chr(0x4E00 + i) for i in range(1000))
    found = [m[0] for m in TOKENS.finditer(f"a {word}. b")]
    assert "".join(found) == f"a{word}.b" and max(map(len, found)) == 64
    grams = {f for w in found for f in features(w)}
    assert all(any(c in g for g in grams) for c in word)


def test_long_values_and_long_words_before_them():
    long = "x" * 200 + "@intern"
    _, found = pii.candidates(f"write   TO Agent7 {long} now", [])
    assert found[4] == [0] and found[5] == ["agent0", "to agent0"] and len(found[2]) == 32
    before = "y" * 60
    text = f"{before} mail a@b.cc:12345678"
    _, found = pii.candidates(text, pii.base_spans(text))
    assert found[2] == "12345678" and found[5] == ["a@b.cc:", "mail a@b.cc:"]
    (found,) = pii.candidates(f"{before} {before} u@v", [])
    assert found[5] == ["y" * 48, "y" * 48 + " " + "y" * 48]
    assert pii.candidates("12345678", [])[0][5] == [] and pii.candidates("", []) == []


def test_words_before_many_places_are_found_in_one_pass():
    text = "tel: 12345678 " * 20_000 + "a1234567b" * 20_000
    found = pii.candidates(text, [])
    assert [f[5] for f in found[:2]] == [["tel:"], ["00000000 tel:", "tel:"]]
