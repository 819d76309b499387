"""Pairs that link share a listed range, and agree in enough ranges, whatever their sizes."""

from __future__ import annotations

import numpy as np
import pytest

from contrail.llm.ngram_join import Rule, _agreeing, range_codes


def listed(codes):
    return set(codes[codes & 1 == 1].tolist())


@pytest.mark.parametrize(("p", "q"), [(90, 100), (80, 100)])
def test_linked_pairs_meet(p, q):
    rule, rng = Rule(p, q), np.random.default_rng(3)
    pairs = 0
    for size in [2, 3, 4, 5, 6, 8, 9, 10, 12, 15, 20, 33, 70, 200, 900] * 40:
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
        keep = a[rng.permutation(len(a))[: len(a) - rng.integers(0, size // 4 + 1)]]
        b = np.unique(np.r_[keep, rng.integers(0, 2**63, rng.integers(0, size // 4 + 1)).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if q * both < p * (len(a) + len(b) - both):
            continue
        pairs += 1
        (ma, ca), (mb, cb) = ((m, c.view(np.int64)) for m, c in (range_codes(a, rule), range_codes(b, rule)))
        assert listed(ca) & listed(cb)
        assert _agreeing(rule, len(a), ma, ca, len(b), mb, cb) >= 0
    assert pairs > 100


def test_few_full_ranges_still_meet():
    rule = Rule(80, 100)
    # All elements in one range: the other ranges are empty on both sides.
    for n in range(4, 40):
        a = np.arange(1, n + 1, dtype=np.uint64)
        b = a[:-1] if rule.q * (n - 1) >= rule.p * n else a
        (ma, ca), (mb, cb) = ((m, c.view(np.int64)) for m, c in (range_codes(a, rule), range_codes(b, rule)))
        assert listed(ca) & listed(cb)
        assert _agreeing(rule, len(a), ma, ca, len(b), mb, cb) >= 0
