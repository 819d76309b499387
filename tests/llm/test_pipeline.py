"""The stages of the corpus pipeline against brute force, on repeated ids, null ids and clashing columns."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from contrail.llm import language_id, toxicity
from contrail.llm.scratch import ship_code, store

DOCS = "doc_id long, text string, lang string, source string, score string, predicted int, lang_pred string, copies int, copy string, _rid string"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(autouse=True)
def _shipped(spark):
    ship_code(spark)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([3, 5, 12, 30, 60]))) for _ in range(50)]
    for t in texts[:25]:
        w = t.split()
        if len(w) > 20:
            w[0] = "changed"
            texts.append(" ".join(w).upper())
    texts += [None, "", " \n "]
    made = [(i, t, ("en", "de", None)[i % 3], ("a", "b", None)[i % 3]) for i, t in enumerate(texts)]
    # Equal rows, another text under a known id, null ids with equal and with other texts.
    made += [made[4], made[4], (4, texts[9] + " " + words[0], "en", "a"), (None, texts[5], "de", "b"), (None, texts[5], "de", "b"), (None, "no id of its own " * 4, "en", "a")]
    return [(*r, "mine", 1, "mine", 7, "c", "r") for r in made]


@pytest.fixture
def docs(spark, rows):
    return store(spark.createDataFrame(rows, DOCS).repartition(3), "docs")


def counted(df):
    return Counter(map(repr, map(tuple, df.collect())))


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_one_row_of_each_group_stays(spark, docs, rows):
    sets = [shingles(r[1]) for r in rows]
    at = list(range(len(rows)))
    while True:
        moved = False
        for a in range(len(rows)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]) and at[a] != at[b]:
                    at[a] = at[b] = min(at[a], at[b])
                    moved = True
        if not moved:
            break
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(at[i], []).append(r)
    got = counted(cp.join_near_duplicates(spark, docs, ""))
    want_ids = Counter(min((r[0] is None, r[0] or 0) for r in group) for group in groups.values())
    kept = cp.join_near_duplicates(spark, docs, "").collect()
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept) == want_ids and len(kept) == len(groups)
    assert set(got) <= set(map(repr, rows)) and {r.score for r in kept} == {"mine"}
    assert got == counted(cp.join_near_duplicates(spark, store(docs.repartition(5), "docs"), ""))


def test_mix_takes_rows_by_themselves(spark, docs, rows):
    got = counted(cp.mix(spark, docs, ""))
    assert got == counted(cp.mix(spark, store(docs.repartition(5), "docs"), ""))
    there = Counter(map(repr, rows))
    assert set(got) <= set(there) and all(n <= 2 * there[r] for r, n in got.items())
    size = lambda r: len(WORD.findall(r[1] or ""))
    by_repr = {repr(r): r for r in rows}
    assert all(size(by_repr[r]) for r in got)
    total = sum(size(r) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r)
    rest, left, want = 1.5 * total, {"a": 3, "b": 1, None: 2}, {}
    while over := [s for s in left if rest * left[s] / sum(left.values()) > 2 * sizes[s] + 1e-9]:
        for s in over:
            want[s] = 2.0 * sizes[s]
            del left[s]
        rest = 1.5 * total - sum(want.values())
    want |= {s: rest * w / sum(left.values()) for s, w in left.items()}
    taken = Counter()
    for r, n in got.items():
        taken[by_repr[r][3]] += n * size(by_repr[r])
    assert all(abs(taken[s] - want[s]) <= max(size(r) for r in rows if r[3] == s) for s in want)


def test_judging_stages_keep_rows_and_columns(spark, docs, rows, tmp_path):
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    model = toxicity.fit(docs, labels.filter(cp._trains()))
    texts = docs.select("doc_id", "text")
    judged = {r.text: r.predicted for r in toxicity.score(texts, model).collect()}
    want = Counter(repr(r) for r in rows if judged[r[1]] == 0)
    assert counted(cp.remove_toxic(spark, docs, str(tmp_path))) == want
    named = {r.text: r.lang_pred for r in language_id.identify(texts, language_id.fit(docs.filter(cp._trains()))).collect()}
    want = Counter(repr(r) for r in rows if named[r[1]] != "und")
    got = cp.identify_language(spark, docs, str(tmp_path))
    assert counted(got) == want and got.columns == docs.columns


def test_all_stages_run_and_empty_tables(spark, docs, rows, tmp_path):
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    packed = cp.run(spark, str(tmp_path)).collect()
    assert packed and max(r.offset + r.length for r in packed) <= 2048
    spans = {}
    for r in packed:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in s) == max(o + n for o, n in s) for s in spans.values())
    none = store(docs.limit(0), "none")
    for _, stage in cp.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0
