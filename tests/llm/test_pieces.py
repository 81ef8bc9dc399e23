"""The best segmentations as paths, not only their scores, where scores tie."""

import itertools

import numpy as np
import pytest

from smelter.llm import pieces
from smelter.llm.queries import PIECE_MODEL

TIED = ["To&&&", "To&&&&&", "aaaa", "a  b", "&&", "ab&&&&cd&&&&", "x\n\ny&&&", "日本&&&", "&&& &&& &&&", "(((()))) To&&&"]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(pieces.model_bytes(PIECE_MODEL))


def all_paths(model, segment):
    """Every path of a segment with its score, best first, ties by ids from the end."""
    paths = [[(0.0, ())]] + [[] for _ in segment]
    for end in range(1, len(segment) + 1):
        for start, score, ids in model._edges(segment, end):
            paths[end] += [(s + score, (*before, *ids)) for s, before in paths[start]]
    return sorted(paths[-1], key=lambda p: (-p[0], p[1][::-1]))


def listed(model, text, n=4):
    """The best path and its successors, edits applied."""
    ids, score, following = next(model.encode([text], n))
    best = ids.tolist()
    found = [(score, tuple(best))]
    for other in following:
        path = list(best)
        for edit in sorted(other["edits"], key=lambda e: -e["at"]):
            path[edit["at"] : edit["at"] + edit["gone"]] = edit["ids"]
        found.append((other["score"], tuple(path)))
    return found


def segments_of(model, text):
    return [s for s in model.segments(text) if s]


@pytest.mark.parametrize("text", TIED)
def test_four_best_paths(model, text):
    per_segment = [all_paths(model, s)[:4] for s in segments_of(model, text)]
    combined = [(sum(s for s, _ in c), tuple(itertools.chain(*(p for _, p in c)))) for c in itertools.product(*per_segment)]
    scores = sorted((s for s, _ in combined), reverse=True)[:4]
    got = listed(model, text)
    assert [s for s, _ in got] == scores
    assert len({p for _, p in got}) == len(got) and set(got) <= set(combined)
    assert got[0][1] == tuple(itertools.chain(*(p[0][1] for p in per_segment)))


def test_viterbi_and_search_agree_on_ties(model):
    rng = np.random.default_rng(4)
    alphabet = list("&&&&&&(((===...Toae")
    segments = list(dict.fromkeys("".join(rng.choice(alphabet, rng.integers(1, 9))) for _ in range(1500)))
    ids, score, loss = model.top_two(segments)
    ties = 0
    for segment, path, best, lost in zip(segments, ids, score, loss):
        first, *rest = all_paths(model, segment)
        assert (best, tuple(path.tolist())) == first
        assert lost == (first[0] - rest[0][0] if rest else np.inf)
        assert model.n_best(segment, 4) == [first, *rest][:4]
        ties += bool(rest) and rest[0][0] == first[0]
    assert ties > 20
