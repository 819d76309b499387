"""Large hosts: parsed pages are written once and stay in their buckets, windows travel as short sets."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd

from contrail.llm import html_text
from contrail.llm.scratch import store_buckets

SCHEMA = "page_id long, url string, html string"


def _say(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def _slice(pages):
    frame = pd.DataFrame([(i, f"http://h/{i}", "h", 100 + k, html) for k, (i, html) in enumerate(pages)], columns=["page_id", "url", "host", "page", "html"])
    (row,) = pd.concat(html_text._packed(html_text._parsed(iter([frame])))).itertuples()
    return row


def test_pages_are_not_shuffled(spark):
    rnd = random.Random(21)
    rows = [(i, f"http://a.example/{i}", f"<nav>{_say(rnd, 9)}</nav><p>{_say(rnd, 30)}</p>") for i in range(12)]
    out = html_text.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3), part_bytes=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning(page" not in plan
    assert {r.page_id: r.n_chars for r in out.collect()} == {i: 30 * 6 - 1 for i in range(12)}


def test_bucketed_rows_meet_without_an_exchange(spark):
    table = store_buckets(spark.range(100).selectExpr("id % 7 AS k", "id"), "test", 4, "k")
    counts = table.groupBy("k").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert sorted(counts.collect()) == sorted((k, len(range(k, 100, 7))) for k in range(7))


def test_slices_hold_whole_pages():
    pages = [(1, "<p>one two one &amp; three<p>two"), (None, None), (3, "<nav>x</nav><article>ä one  nine</article>"), (4, "")]
    row = _slice(pages)
    part = html_text._Slice(row)
    ends = np.cumsum(part.sizes)[:-1]
    assert [" ".join(x) for x in np.split(part.words[part.codes], ends)] == ["one two one & three", "two", "x", "ä one nine"]
    assert part.kinds.tolist() == [1, 1, 0, 2] and part.page.tolist() == [0, 0, 2, 2] and part.main.tolist() == [True, True, False, True]
    assert list(row.page_ids) == ["1", None, "3", "4"] and list(row.pages) == [100, 101, 102, 103]
    empty = html_text._Slice(_slice([(1, None), (2, "")]))
    assert empty.count == 2 and len(empty.h) == len(empty.codes) == 0


def test_windows_are_equal_where_their_words_are():
    rnd = np.random.default_rng(4)
    sizes, hosts = rnd.integers(1, 20, 60), rnd.integers(0, 2, 60).astype(np.uint64)
    words = rnd.integers(0, 2, sizes.sum()).astype(np.uint64)
    h, begins, block = html_text.windows(words, sizes, hosts)
    want, lo = [], 0
    for b, n in enumerate(sizes.tolist()):
        runs = [(0, n)] if n < html_text.RUN else [(i, i + html_text.RUN) for i in range(n - html_text.RUN + 1)]
        want += [(b, lo + i, (hosts[b], *words[lo + i : lo + j])) for i, j in runs]
        lo += n
    assert [*zip(block.tolist(), begins.tolist(), strict=True)] == [x[:2] for x in want]
    assert len({*h.tolist()}) == len({x[2] for x in want}) == len({*zip(h.tolist(), (x[2] for x in want), strict=True)})


def test_windows_are_sent_in_few_bytes(spark):
    rnd = random.Random(22)
    common, bits = _say(rnd, 20), 40
    rows = [_slice([(i, f"<p>{_say(rnd, 3000)}</p><p>{common}</p>")])._replace(slice=i) for i in range(3)]
    frame = spark.createDataFrame(pd.DataFrame([r[1:] for r in rows], columns=list(rows[0]._fields[1:])), html_text.PACKED)
    short = [{*html_text._short(html_text._Slice(r).h, bits).tolist()} for r in rows]
    found = {r["slice"]: {*html_text._sets([bytes(x) for x in r["found"]]).tolist()} for r in html_text._sent(frame, bits, 3).groupBy("slice").agg({"found": "collect_list"}).toDF("slice", "found").collect()}
    assert found == {i: short[i] & (short[i - 1] | short[i - 2]) for i in range(3)} and all(len(x) >= 13 for x in found.values())
    numbers = np.unique(np.random.default_rng(3).integers(0, 1 << 31, 1 << 16).astype(np.uint64))
    assert len(html_text._set(numbers)) < 2.5 * len(numbers) and (html_text._sets([html_text._set(numbers)]) == numbers).all()


def test_repeats_across_slices(spark):
    rnd = random.Random(23)
    plate, passage, twice = _say(rnd, 12), _say(rnd, 14), _say(rnd, 40)
    rows = [(i, f"http://h/{i}", f"<article><p>{_say(rnd, 30)}</p><p>{plate}</p></article>") for i in range(9)]
    rows += [(20 + i, f"http://h/l{i}", f"<div>{_say(rnd, 9)} {passage} {_say(rnd, 9)}</div><div>Go on</div>") for i in range(4)]
    rows += [(30, "http://h/same", f"<p>{twice}</p>")] * 3 + [(40 + i, f"http://h/copy{i}", f"<p>{twice} end</p>") for i in range(2)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, html_text.main_text(frame).collect()))
    for parts in (1, 6):
        assert sorted(map(tuple, html_text.main_text(frame.repartition(parts), part_bytes=100).collect())) == want
    assert not any(plate in w[2] or passage in w[2] for w in want) and sum(twice in w[2] for w in want) == 5
