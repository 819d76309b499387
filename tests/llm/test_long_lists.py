"""Members of long lists are decided inside tasks: no pair of them leaves, only links between components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from contrail.llm import ngram_join
from contrail.llm.ngram_join import Rule, _block_links, _broad, range_codes


def _texts(bridge: bool) -> list[str]:
    """Two families of 60 near copies, a little less alike than a link needs; the bridge is alike to both."""
    base = [f"w{i}" for i in range(200)]
    other = base[:60] + [f"z{i}" for i in range(18)] + base[78:]
    half = base[:60] + [f"z{i}" for i in range(9)] + base[69:]
    out = [" ".join([*words[:-1], f"{name}{i}"]) for i in range(60) for name, words in (("a", base), ("b", other))]
    return [*out, " ".join([*half[:-1], "c"])] if bridge else out


def _components(texts: list[str]) -> list[int]:
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    least = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and least[i] != least[j]:
                low, high = sorted((least[i], least[j]))
                least = [low if x == high else x for x in least]
    return least


@pytest.mark.parametrize("bridge", [False, True])
def test_families_that_hardly_differ_move_no_pairs(spark, monkeypatch, bridge):
    checked = []
    verified = ngram_join._verified

    def counted(pairs, *rest):
        checked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_verified", counted)
    texts = _texts(bridge)
    got = ngram_join.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 80, 100)
    found = {r.doc_id: r.component_id for r in got.collect()}
    want = _components(texts)
    assert len(set(want)) == (1 if bridge else 2)
    assert [found[i] for i in range(len(texts))] == want
    assert sum(checked) <= 3 * len(texts)  # with heads only; the families have 3,600 pairs


def test_two_blocks_give_fewer_links_than_components():
    rule = Rule(80, 100)
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64) * np.uint64(2))
    rows = []
    for sid in range(1, 101):
        u = np.unique(np.r_[base[1:], rng.integers(0, 2**63, 1).astype(np.uint64)])
        ms, codes = range_codes(u, rule)
        at = ms.index(64)
        rows.append((sid, len(u), _broad(codes[sum(ms[:at]) :][:64]).tobytes(), u.tobytes(), codes[sum(ms[:at]) :][:64]))
    shared = np.flatnonzero([len({r[4][k] for r in rows}) == 1 and rows[0][4][k] & np.uint64(1) for k in range(64)])
    code = int(rows[0][4][shared[0]].view(np.int64))
    g = pd.DataFrame(
        {
            "code": code, "i": 0, "j": 0, "head": 0, "sid": [r[0] for r in rows], "component": [r[0] // 2 for r in rows],
            "own": 0, "n_shingles": np.array([r[1] for r in rows], np.int32), "broad": [r[2] for r in rows], "elems": [r[3] for r in rows],
        }
    )
    got = _block_links(g, rule)
    assert len(got) == g["component"].nunique() - 1
    joined = {r[0]: r[0] // 2 for r in rows}
    for a, b in got.itertuples(index=False):
        low, high = sorted((joined[a], joined[b]))
        joined = {k: low if v == high else v for k, v in joined.items()}
    assert len(set(joined.values())) == 1
