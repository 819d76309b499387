"""The operators against brute force on small tables with nulls, ties, repeats and odd columns."""

from __future__ import annotations

import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import html_text, language_id, mixing, packing, queries, sharding, token_counts, toxicity
from contrail.llm.ann import nearest
from contrail.llm.components import connected, extended
from contrail.llm.exact_topk import top_products
from contrail.llm.ngram_join import similar_groups
from contrail.llm.scratch import ship_code, store

DOCS = "doc_id long, text string, lang string, source string, size string, score string, slot string"


@pytest.fixture(autouse=True)
def _shipped(spark):
    ship_code(spark)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 5, 11, 14, 40, 90]))) for _ in range(60)]
    for t in list(texts[:40]):
        w = t.split()
        if len(w) > 8:
            w[rnd.randrange(len(w))] = "changed"
        texts.append("\t".join(w).upper())
    texts += [texts[3]] * 5 + [None, "", " \n ", "ünï — ça <|endoftext|> b<|endoftext|>", "x" * 300_000 + " y " * 4000]
    return [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], "9", "x", "y") for i, t in enumerate(texts)] + [
        (None, "no id", "en", "a", None, None, None), (7, texts[7], "en", "b", None, None, None),
    ]


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def components(rows, k, p, q):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    sets.pop(None, None)
    at = {i: i for i in sets}
    for _ in sets:
        moved = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and sets[a] and q * both >= p * len(sets[a] | sets[b]) and at[a] != at[b]:
                    at[a] = at[b] = min(at[a], at[b])
                    moved = True
        if not moved:
            break
    return {i: (len(s), at[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "p", "q"), [(3, 90, 100), (5, 8, 10)])
def test_groups_equal_brute_force(docs, rows, k, p, q):
    got = similar_groups(docs, k, p, q).collect()
    assert len(got) == len(rows)
    want = components(rows, k, p, q)
    for r in got:
        assert (r.n_shingles, r.component_id) == (want[r.doc_id] if r.doc_id is not None else (1, None))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, j) for j in range(6, 60)] + [(7, 7), (None, 1)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[j] for j in range(5, 60)} == {5} and len(got) == 96


def test_components_after_more_edges(spark):
    rnd = random.Random(5)
    for n, few, more in ((40, 25, 20), (300, 250, 40)):
        first = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(few)]
        second = [(rnd.randrange(n), rnd.randrange(n + 5)) for _ in range(more)]
        at = {x: x for e in first + second for x in e}
        for _ in at:
            for a, b in first + second:
                at[a] = at[b] = min(at[a], at[b])
        frames = [spark.createDataFrame(e, "a long, b long") for e in (first, second)]
        got = {r.node: r.component for r in extended(connected(frames[0]), frames[1]).collect()}
        loops = {a for a, b in first + second if a == b}
        assert {k: got.get(k, k) for k in at} == at
        assert set(at) - set(got) <= loops


def vectors(spark):
    rng = np.random.default_rng(0)
    made = [(i, [float(x) for x in rng.normal(size=16) * (1 + i % 5)], "z") for i in range(120)]
    made += [(200 + i, made[0][1], "z") for i in range(30)]
    made += [(300, None, "z"), (301, [0.0] * 16, "z"), (302, [float("nan")] * 16, "z"), (303, [None] * 16, "z"), (None, made[1][1], "z"), (5, made[5][1], "z")]
    return made, spark.createDataFrame(made, "vec_id long, embedding array<double>, score string")


def ranked(made, every, k, whole):
    usable = {i: np.array(v) for i, v, _ in made if i is not None and v and None not in v and np.isfinite(v).all() and (whole or any(v))}
    if whole:
        usable = {i: np.floor(1024 * v).astype(int) for i, v in usable.items()}
    out = {}
    for q in usable:
        if q % every == 0:
            out[q] = sorted(((float((usable[q] * v).sum()), i) for i, v in usable.items() if i != q), key=lambda x: (-x[0], x[1]))[:k]
    return out


def test_exact_search_equals_brute_force(spark):
    made, df = vectors(spark)
    got = {}
    for r in top_products(df, "id % 10 = 0", 10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((float(r.score), r.vec_id))
    assert got == ranked(made, 10, 10, True)


def test_nearest_finds_most(spark):
    made, df = vectors(spark)
    want, got = ranked(made, 20, 20, False), {}
    for r in nearest(df, "id % 20 = 0", 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in got)
    hit = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hit >= 0.9 * 20 * len(want)
    assert all(got[q] == sorted(got[q], key=lambda x: (-x[0], x[1])) for q in got)


def test_mix_meets_targets(docs, rows):
    got = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    size, taken, target = {}, {}, {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        size[r.source] = size.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    # One document of a source may stay off, and that only by what no other can make up.
    longest = {s: max(r.size for r in got if r.source == s) for s in size}
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in size)
    assert sum(abs(taken[s] - target[s]) <= 40 for s in size) >= len(size) - 1
    left, want = dict(zip(["a", "b", None], (3, 1, 2), strict=True)), {}
    while True:  # reshare until none is above its limit
        rest = 1.5 * sum(size.values()) - sum(want.values())
        over = [s for s in left if rest * left[s] / sum(left.values()) > 2 * size[s] + 1e-9]
        if not over:
            break
        for s in over:
            want[s] = 2.0 * size[s]
            del left[s]
    want |= {s: rest * w / sum(left.values()) for s, w in left.items()}
    assert target == pytest.approx(want)


def test_shards_are_gapless_and_grow(docs, rows):
    df = docs.drop("size").withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    got = sharding.shard_rows(df, 5, bucket_bytes=4000).collect()
    assert len(got) == len(rows)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 5) for r in got)
    # Several buckets a task: the same shards and slots.
    few = sharding.shard_rows(df, 5, bucket_bytes=4000, partitions=2)
    assert few.rdd.getNumPartitions() <= 2
    key = lambda r: (str(r.doc_id), r.text or "", r.shard)
    few = few.collect()
    assert sorted(map(key, few)) == sorted(map(key, got))
    assert sorted((r.shard, r.slot) for r in few) == sorted((r.shard, r.slot) for r in got)
    six = {r.doc_id: r.shard for r in sharding.shard_rows(df, 6).collect()}
    assert all(six[r.doc_id] == r.grown_shard for r in got)


def test_written_shards_hold_whole_documents(spark, docs, rows, tmp_path):
    repeated = docs.unionByName(docs.filter("doc_id = 1").crossJoin(spark.range(400)).drop("id"))
    df = repeated.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    sharded = sharding.shard_rows(df, 5, bucket_bytes=4000)
    cells = sharded.select("doc_id", "text", F.spark_partition_id().alias("cell")).filter("doc_id = 1").distinct()
    assert cells.count() > 1  # equal rows spread
    written = sharding.write_shards(sharded, str(tmp_path / "shards"))
    kept = [c for c in df.columns if c != "slot"]  # replaced by the result
    assert sorted(map(str, written.select(*kept).collect())) == sorted(map(str, df.select(*kept).collect()))
    for s in range(5):
        files = sorted((tmp_path / "shards" / f"shard={s}").glob("*.parquet"))
        slots = [x.slot for f in files for x in spark.read.parquet(str(f)).select("slot", "_metadata.row_index").orderBy("row_index").collect()]
        assert slots == list(range(written.filter(F.col("shard") == s).count()))


def test_shard_query_writes_whole_documents(spark, docs, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    docs.drop("size").write.parquet(str(tmp_path / "documents.parquet"))
    before = set(Path(base).glob("shards-*"))
    got = queries.op8_shard(spark, str(tmp_path)).collect()
    (made,) = set(Path(base).glob("shards-*")) - before
    text = {(r.doc_id, zlib.crc32((r.text or "").encode())) for r in spark.read.parquet(str(made)).collect()}
    assert {(r.doc_id, r.text_crc32) for r in got} == text and len(got) == docs.count()


def test_differencing_known_case():
    assert sorted(packing.differencing(np.array([8, 7, 6, 5, 4]), 2)[1].tolist()) == [14, 16]


def test_packing_round_trip(docs, rows):
    got = packing.pack_documents(docs).collect()
    fills = {}
    for r in got:
        assert len(r.ids) == 4 * r.length
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in fills.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t, *_ in rows:
        if i is not None and i != 7 and len(t or "") < 5000:
            ids = [*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
            held = b"".join(r.ids for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start))
            assert zlib.crc32(held) == zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_counts_follow_edits():
    counter, rnd = token_counts.Counter(), random.Random(3)
    for _ in range(150):
        text = "".join(rnd.choice(["ab ", "don't", "\n", "  ", "12", "é", "!?", " word"]) for _ in range(rnd.randint(0, 200)))
        doc = token_counts.Document(text, counter)
        for _ in range(4):
            a = rnd.randint(0, len(doc.text))
            b = rnd.randint(a, min(len(doc.text), a + 30))
            doc.edit(a, b, rnd.choice(["", "x", " new words", "\n\n"]))
            assert doc.tree.tokens == len(counter.encode(doc.text)) and doc.tree.chars == len(doc.text)


def test_many_edits_stay_local():
    counter, rnd = token_counts.Counter(), random.Random(6)
    words = ["alpha", "be", "  gamma", "\n\n", "don't", "12", " ", "x@y.org", "é!"]
    for edits in (1, 60, 1600):
        text = " ".join(rnd.choice(words) for _ in range(6 * edits)) + " " + " filler word" * 50
        for _ in range(1 if edits > 100 else 3):
            at = sorted(rnd.sample(range(len(text)), 2 * edits))
            cuts = [(a, min(b, a + 9), rnd.choice(["", "[masked]", " a b", "\n"])) for a, b in zip(at[::2], at[1::2], strict=True)]
            doc = token_counts.Document(text, counter)
            before = doc.counted
            doc.apply(cuts)
            want = list(text)
            for a, b, new in reversed(cuts):
                want[a:b] = new
            assert doc.text == "".join(want)
            assert doc.tree.tokens == len(counter.encode(doc.text)) == doc.counts.sum() and doc.tree.chars == len(doc.text)
            assert [len(p) for p in counter.pattern.findall(doc.text)] == np.diff(doc.ends, prepend=0).tolist()
            assert doc.counted - before <= edits * 3 * token_counts.LEAF
            assert doc.counted - before <= 12 * edits


def test_counts_query(docs, rows):
    got = token_counts.count_edited(docs).collect()
    assert len(got) == len(rows) and all(r.tokens_before == 0 for r in got if r.pretokens == 0)


PAGE = (
    "<html><head><title>T</title><script>if(a<b){'</p>'}</script></head><body><nav><a>Menu</a></nav>"
    "<div class='cookie-notice'>We use cookies</div><article class=post><h1>Head &amp; more</h1><p><b>One</b>two<br>three<p>Four&nbsp; five"
    "<aside>Side</aside><div id=comments>Nice!</div></article><footer>&copy; x</footer>"
)


def test_article_of_a_page(spark):
    plate = "<div>all of these many words stand on every page of the host</div>"
    pages = [
        (1, "http://h/1", PAGE), (2, None, None), (3, "http://h/3", ""), (4, "http://h/4", PAGE[:-30]),
        (5, "http://k/5", f"<body>{plate}<div>only here are these words and no other page has them at all</div>"),
        (6, "http://k/6", f"<body>{plate}<p>quite another text of a page that nobody has copied so far"), (1, "http://h/1", PAGE),
    ]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.main_text(df).collect()}
    assert got[1].text == "Head & more Onetwo three Four five" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[4].text == got[1].text
    assert got[5].text.startswith("only here") and got[6].text.startswith("quite another")
    assert html_text.main_text(df).count() == len(pages)


def test_main_around_an_article_is_loose():
    page = "<main><div>Teaser</div><article><header>Head</header><p>One <span class='social'>word</span> two</article><p>More</main><p>out"
    assert html_text.blocks(page) == [(1, "Teaser"), (2, "Head"), (2, "One word two"), (1, "More"), (1, "out")]
    assert html_text.blocks("<p>a<main><p>b<div class=ad>c</div></main>") == [(1, "a"), (2, "b"), (0, "c")]


def test_repeats_cut_inside_articles(spark):
    rnd = random.Random(11)
    say = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    plate, passage = say(12), say(14)
    article, own = [say(40) for _ in range(6)], [say(6) for _ in range(6)]
    pages = [(i, f"http://h/{i}", f"<article><p>{article[i]}</p><p>{plate}</p></article>") for i in range(4)]
    pages += [(10 + i, f"http://h/copy{i}", f"<article><p>{article[0]}</p><p>{plate}</p></article>") for i in range(3)]
    pages += [(20 + i, f"http://h/l{i}", f"<div>{article[4 + i]} {passage} {own[i]}</div>") for i in range(2)]
    pages += [(30 + i, f"http://k/{i}", f"<div>{article[5]}</div><div>Short line</div>") for i in range(2)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = {i: article[i] for i in range(4)} | {10 + i: article[0] for i in range(3)}
    want |= {20 + i: f"{article[4 + i]} {own[i]}" for i in range(2)} | {30 + i: f"{article[5]} Short line" for i in range(2)}
    assert {r.page_id: r.text for r in html_text.main_text(df).collect()} == want
    small = html_text.main_text(df, part_bytes=300)  # every host is larger than a part
    assert sorted(map(str, small.collect())) == sorted(map(str, html_text.main_text(df).collect()))


@pytest.mark.parametrize("part_bytes", [300, html_text.PART_BYTES])
def test_articles_keep_their_sentences(spark, part_bytes):
    rnd = random.Random(12)
    say = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    lead, common, notice, own = say(14), say(12), say(10), [say(20) for _ in range(6)]
    pages = [
        (1, f"<article><p>{lead}</p><p>{own[0]}</p><p>{notice}</p></article>"),
        # A teaser of page 1 in an aside and in a loose block next to the article.
        (2, f"<aside>{lead}</aside><article><p>{own[1]}</p><p>{common}</p><p>{notice}</p></article>"),
        (3, f"<div class='menu'>{lead}</div><article><p>{own[2]}</p><p>{common}</p><p>{notice}</p></article>"),
        (4, f"<article><p>{own[3]}</p><p>{notice}</p></article>"), (5, f"<article><p>{own[4]}</p></article>"), (6, f"<article><p>{own[5]}</p></article>"),
    ]
    df = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in pages], "page_id long, url string, html string")
    want = {1: f"{lead} {own[0]}", 2: f"{own[1]} {common}", 3: f"{own[2]} {common}", 4: own[3], 5: own[4], 6: own[5]}
    assert {r.page_id: r.text for r in html_text.main_text(df, part_bytes=part_bytes).collect()} == want


def test_repeats_equal_brute_force():
    rnd = np.random.default_rng(5)
    for run in (2, 3, 8):
        tokens, pages = rnd.integers(0, 3, 120), np.sort(rnd.integers(0, 4, 120))
        want = np.zeros(120, bool)
        for i in range(121 - run):
            for j in range(121 - run):
                if pages[i] != pages[j] and (tokens[i : i + run] == tokens[j : j + run]).all():
                    want[i : i + run] = True
        assert (html_text.repeats(tokens, pages, run) == want).all()


def test_language_forward_sums_all_segmentations():
    vocab = language_id.vocabulary()
    pieces = np.random.default_rng(2).random((len(vocab.hashes) + 1, 2)) * 0.1
    pieces[-1] = 0
    data = np.frombuffer(b"there", np.uint8)

    def total(word: bytes) -> np.ndarray:
        if not word:
            return np.ones(2)
        out = np.zeros(2)
        for n in range(1, len(word) + 1):
            at = vocab.find(np.array([language_id._string_hash(word[:n])], dtype=np.uint64))[0]
            out = out + pieces[at] * (total(word[n:]) if at < len(vocab.hashes) else 0)
        return out

    got = language_id._log_probabilities(data, np.array([0]), np.array([5]), vocab, pieces)[0]
    assert np.allclose(np.exp(got), total(b" there"))


def _log_total(word: bytes, vocab, pieces) -> np.ndarray:
    """log of the sum over all segmentations, prefix by prefix in logarithms."""
    at = [np.zeros(pieces.shape[1])]
    for end in range(1, len(word) + 1):
        some = []
        for start in range(max(0, end - vocab.longest), end):
            number = vocab.find(np.array([language_id._string_hash(word[start:end])], dtype=np.uint64))[0]
            if number < len(vocab.hashes):
                some.append(at[start] + np.log(pieces[number]))
        at.append(np.logaddexp.reduce(some))
    return at[-1]


def test_long_words_count_whole():
    vocab = language_id.vocabulary()
    pieces = np.random.default_rng(3).random((len(vocab.hashes) + 1, 3)) * 1e-4 + 1e-9
    pieces[-1] = 0
    assert vocab.longest > 20
    rnd = random.Random(5)
    words = [b"internationalisation" * k for k in (1, 2, 5)] + [bytes(rnd.choice(b"etaoinsh") for _ in range(n)) for n in (26, 27, 28, 29, 33, 90, 300)]
    words += ["漢字仮名".encode() * 20]
    data = np.frombuffer(b".".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    got = language_id._log_probabilities(data, starts, ends, vocab, pieces)
    want = np.array([_log_total(b" " + w, vocab, pieces) for w in words])
    assert np.allclose(got, want, rtol=1e-9)


def test_every_label_is_learned(spark):
    texts = {f"l{i:03d}": " ".join(chr(97 + (i * 7 + j * j) % 26) * 2 + chr(97 + i % 26) * 3 for j in range(8)) for i in range(230)}
    df = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(texts.items())] + [(0, None, "l000")], "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert model.languages == sorted(texts) and model.pieces.shape[1] == 230


def test_languages_and_odd_texts(spark):
    en, de = "the cat and the house of this man with that thing", "der hund und das haus von diesem mann mit einer sache"
    data = [(i, (en, de)[i % 2], ("en", "de")[i % 2], "s") for i in range(20)]
    data += [(50, None, None, "s"), (51, "", "en", "s"), (52, "12 3 —", "de", "s"), (53, en.upper(), None, "s"), (54, "漢字", None, "s"), (None, de, "en", "s")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in language_id.identify(df, language_id.fit(df.filter("doc_id < 50"))).collect()}
    assert [got[i].lang_pred for i in (0, 1, 50, 51, 52, 53, None)] == ["en", "de", "und", "und", "und", "en", "de"]
    assert got[54].lang_pred in ("en", "de") and all(0 <= r.score <= 1 for r in got.values())
    none = language_id.identify(df, language_id.fit(df.limit(0))).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_toxic_sentence_is_found(spark):
    rnd = random.Random(4)
    clean = lambda: " ".join(rnd.choice("the house stands near some river with old trees".split()) for _ in range(8)) + "."
    data = []
    for i in range(300):
        parts = [clean() for _ in range(4)]
        if i % 3 == 0:
            parts[2] = "you are nastyword indeed."
        data.append((i, " ".join(parts), int(i % 3 == 0)))
    df = spark.createDataFrame([(*d[:2], "q") for d in data] + [(900, None, "q"), (901, "", "q")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, t) for i, _, t in data if i < 200] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert all(got[i].predicted == t for i, _, t in data) and got[900].score == got[901].score == 0.0
    r = got[297]
    assert dict((i, x) for i, x, _ in data)[297][r.sentence_start : r.sentence_end] == "you are nastyword indeed"
    empty = toxicity.fit(df, labels.limit(0))
    assert {r.predicted for r in toxicity.score(df, empty).collect()} == {0}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert similar_groups(docs).count() == 0
    assert mixing.mix_sources(docs).count() == 0
    assert packing.pack_documents(docs).count() == 0
    assert sharding.shard_rows(docs.withColumn("size", F.lit(1)), 4).count() == 0
    assert token_counts.count_edited(docs).count() == 0
    vec = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(vec, "id % 20 = 0").count() == 0 and top_products(vec, "id % 10 = 0").count() == 0
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_stored_tables_keep_rows(docs, rows):
    assert store(docs, "x").count() == len(rows)
