"""Probabilities of the class models against counting by hand, in any script."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from smelter.llm import toxicity

TEXTS = {0: ["the cat sat on the mat", "a cat ate", "кот съел мышь", "猫 在 这里"], 1: ["the bad cat", "bad bad thing", "плохой кот", ""]}


def _corpus() -> tuple[list, list]:
    """Ids that teach the models hold TEXTS in turn, ids of the curve and held-out ones plain words."""
    rows, labels, at = [], [], Counter()
    for i in range(80):
        part, c = zlib.crc32(str(i).encode()) % 5, i % 2
        text = "held out" if part in (0, 4) else TEXTS[c][at[c] % 4]
        at[c] += part not in (0, 4)
        rows.append((i, text))
        labels.append((i, c))
    return rows, labels


def _by_hand(rows, labels):
    """log P(word | 1) - log P(word | 0), from dictionaries of strings."""
    letters, pairs = Counter(), Counter()
    for _, text in rows:
        for word in text.split():
            padded = f" {word} "
            pairs.update(padded[k : k + 2] for k in range(len(padded) - 1))
    for pair, n in pairs.items():
        letters[pair[1]] += n
    cells = 1 << toxicity.LETTER_BITS
    mass = sum(letters.values()) + 0.01 * cells
    grams = {c: defaultdict(Counter) for c in (0, 1)}
    for (i, text), (_, c) in zip(rows, labels):
        if zlib.crc32(str(i).encode()) % 5 in (1, 2, 3):
            for word in text.split():
                padded = f" {word} "
                for size in (3, 4, 5):
                    grams[c][size].update(padded[k : k + size] for k in range(len(padded) - size + 1))
    for c in (0, 1):
        for size in (3, 4):
            left = Counter(g[1:] for g in grams[c][size + 1])
            grams[c][size] = Counter({g: n if g[0] == " " else left[g] for g, n in grams[c][size].items()})

    def discounted(counts, gram, lower):
        total = sum(n for g, n in counts.items() if g[:-1] == gram[:-1])
        if not total:
            return lower
        kinds = sum(g[:-1] == gram[:-1] for g in counts)
        return max(counts[gram] - toxicity.DISCOUNT, 0) / total + toxicity.DISCOUNT * kinds / total * lower

    def log_p(word, c):
        padded, total = f" {word} ", 0.0
        for k in range(1, len(padded)):
            p = discounted(pairs, padded[k - 1 : k + 1], (letters[padded[k]] + 0.01) / mass)
            for size in (3, 4, 5):
                if k - size + 1 >= 0:
                    p = discounted(grams[c][size], padded[k - size + 1 : k + 1], p)
            total += math.log(p)
        return total

    return lambda word: log_p(word, 1) - log_p(word, 0)


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = _corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as toxic", "doc_id as label_id", "1 as n")
    return toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int")), _by_hand(rows, labels)


def test_evidence_equals_counting_by_hand(trained):
    models, by_hand = trained
    words = ["the", "cat", "bad", "thing", "батон", "плохой", "猫", "мышь", "zebra", "a", "in", "held"]
    assert np.allclose(models.evidence(words), [by_hand(w) for w in words], atol=1e-5)


def test_scripts_do_not_share_grams(trained):
    models, _ = trained
    bad, other = models.evidence(["плохой", "".join(chr(ord(x) + 127) for x in "плохой")])
    assert bad > 1 > abs(other)


def test_every_labelled_document_teaches(spark):
    """A word in one toxic document alone counts, however many others there are."""
    rows = [(i, f"word{i % 50} and some more") for i in range(30_000)]
    rare = next(i for i in range(29_000, 30_000) if zlib.crc32(str(i).encode()) % 5 == 2)
    rows[rare] = (rare, "qyxxzv")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == rare or i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    assert toxicity.train(docs, labels).evidence(["qyxxzv"])[0] > 5
