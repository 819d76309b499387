"""Short lists are compared inside tasks, whatever batches their rows come in."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from contrail.llm.ngram_join import Rule, _agreeing, _list_pairs, _whole_lists, range_codes


def _lists(rule):
    """List rows of sets that share some of their elements, sorted by code, and the sets' sizes, ms and marks."""
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 2**63, 60).astype(np.uint64) * np.uint64(2)
        sets += [np.unique(np.r_[base[: 60 - k], rng.integers(0, 2**63, k).astype(np.uint64)]) for k in (0, 3, 5, 8, 30, 50)]
    rows, known = [], {}
    for sid, u in enumerate(sets):
        ms, codes = range_codes(u, rule)
        marks = (codes >> np.uint64(56)).astype(np.uint8)
        known[sid] = (len(u), ms, marks)
        for code in codes[codes & np.uint64(1) == 1]:
            m = 1 << int(code >> np.uint64(1) & np.uint64(31))
            assert m in ms  # a code names its m
            rows.append((int(code.view(np.int64)), sid, len(u), marks[m - ms[0] :][:m].tobytes()))
    rows.sort()
    heads = {}
    for code, sid, *_ in rows:
        heads.setdefault(code, sid)
    table = pa.table(
        {
            "code": pa.array([r[0] for r in rows], pa.int64()), "head": pa.array([heads[r[0]] for r in rows], pa.int64()),
            "sid": pa.array([r[1] for r in rows], pa.int64()), "component": pa.array([r[1] for r in rows], pa.int64()),
            "n_shingles": pa.array([r[2] for r in rows], pa.int32()), "marks": pa.array([r[3] for r in rows], pa.binary()),
        }
    )
    return table, known


def test_pairs_of_lists_are_those_that_agree():
    rule = Rule(80, 100)
    table, known = _lists(rule)
    rows = table.select(["code", "head", "sid"]).to_pylist()
    want = set()
    for x in rows:
        for y in rows:
            if x["code"] == y["code"] and x["head"] < x["sid"] < y["sid"]:
                d = rule.differ(known[x["sid"]][0] + known[y["sid"]][0])
                m = 1 << (x["code"] >> 1 & 31)
                if m == rule.ranges(d) and _agreeing(rule, *known[x["sid"]], *known[y["sid"]]) >= 0:
                    want.add((x["sid"], y["sid"]))
    assert want
    for size in (1, 7, 100, 10_000):
        got = set()
        for part in _whole_lists(iter(table.to_batches(max_chunksize=size))):
            got |= set(zip(*(v.tolist() for v in _list_pairs(part, rule)), strict=True))
        # Marks are compared in all their bits here, and in all but one there.
        assert got <= want and {p for p in want if p[1] // 6 == p[0] // 6 and p[1] % 6 < 4} <= got


def test_a_list_with_hundreds_of_members_moves_no_pairs(spark, monkeypatch):
    """Texts that share a passage and nothing else are compared inside tasks: no pair of them is joined."""
    from contrail.llm import ngram_join

    weighed = []
    promising = ngram_join._promising

    def counted(pairs, reps, rule):
        weighed.append(pairs.count())
        return promising(pairs, reps, rule)

    monkeypatch.setattr(ngram_join, "_promising", counted)
    passage = " ".join(f"same{i}" for i in range(12))
    rows = [(i, f"{' '.join(f'w{i}x{j}' for j in range(60))} {passage}") for i in range(40)]
    got = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i) for i in range(40)]
    assert sum(weighed) <= len(rows)  # with the lists' heads only
