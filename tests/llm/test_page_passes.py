"""Large hosts: html is parsed for the windows and for the cut, a slice at a time, and nowhere else."""

from __future__ import annotations

import pandas as pd

from contrail.llm import html_text


def test_html_is_parsed_twice(spark, monkeypatch):
    parsed = []
    read = html_text._read

    def counted(rows):
        parsed.append(1)
        return read(rows)

    monkeypatch.setattr(html_text, "_read", counted)
    rows = [(i, f"http://a.example/{i}", f"<nav>one two three</nav><p>{' '.join(f'w{i}x{j}' for j in range(30))}</p>") for i in range(8)]
    out = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), part_bytes=50)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # The hosts' parsed pages in memory (none here), the parsed pages that are cut, and the cut: no other Python pass.
    assert plan.count("MapInPandas") == 3 and len(parsed) == 2
    assert all(r.n_chars > 0 for r in out.collect())


def test_batches_are_parsed_in_slices(monkeypatch):
    monkeypatch.setattr(html_text, "SLICE_CHARS", 40)
    page = {"page_id": range(5), "url": ["u"] * 5, "host": ["h"] * 5, "page": range(5), "html": ["<p>" + "a " * 10, None, "<p>b", "c" * 100, ""]}
    parts = list(html_text._parsed(iter([pd.DataFrame(page)])))
    assert [len(p) for p in parts] == [3, 1, 1]
    assert [b for p in parts for b in p["blocks"]] == [[("a " * 10).strip()], [], ["b"], ["c" * 100], []]
