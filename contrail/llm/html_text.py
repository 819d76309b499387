"""Main text of web pages, with a host suffix array against boilerplate.

A page is read into blocks: inside an article element (or main), inside a part
that markup names (menus, footers, adverts, ...), or loose. The token streams
of a host's pages are laid end to end and their suffixes sorted by prefix
doubling; runs of at least ``RUN`` tokens that occur on different pages are the
host's repeats. They are cut out of the loose blocks of a page without an article;
the runs between them stay. Inside an article a run goes only where the articles
of a good share of the host's pages have it (``PLATE_SHARE``, and ``PLATE_LEAST``
of them at least): a sentence that two articles share is the articles' own, and
what a menu, an aside or a teaser shows of an article says nothing against it.
Pages that are copies of one another count as one page, so an article that a host
shows on several pages stays.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.components import connected
from contrail.llm.scratch import store, store_buckets
from contrail.llm.textbytes import mix

RUN = 8  # tokens of the shortest repeat that counts
COPY_PART, COPY_OF = 2, 3  # share of both pages' windows that makes them copies
PLATE_SHARE = 0.5  # share of a host's pages whose articles have a run that goes from articles
PLATE_LEAST = 3  # and how many pages that are at least
PART_BYTES = 2 << 20  # html of a host that is laid end to end
SLICE_CHARS = 2 << 20  # text that a task lays end to end when it hashes windows
HITS = 1 << 20  # windows that a task holds when it tells slices what goes
MOST_BUCKETS = 100_000  # Spark's limit for a table
BROADCAST_HOSTS = 1_000_000  # most hosts whose part counts are sent to all executors, and most pages that are copies

NAMED, LOOSE, CORE, MAIN = 0, 1, 2, 3  # MAIN is only known while a page is read
PACKED = (
    "slice long, pages array<long>, page_ids array<string>, urls array<string>, hosts binary, blocks binary, kinds binary, "
    "sizes binary, words binary, words_bytes long, codes binary"
)
RESULT = "page_id long, url string, text string, n_chars long, n_repeated long"

# Element and attribute names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noframes noembed xmp".split())
PARTS = set(
    "head nav footer aside form script style noscript template svg math iframe object canvas audio video button "
    "select textarea dialog menu label fieldset option datalist title".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of class and id values that name parts around the article.
NAMES = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login "
    "sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer footnav topbar toolbar comment "
    "comments disqus respond replies reply social share sharing related recommended recommendations widget widgets "
    "pagination pager skip masthead".split()
)
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)


def _named(name: str, rest: str, in_core: bool) -> bool:
    """Whether markup says that an element is a part around the article."""
    if name in PARTS or (name == "header" and not in_core):
        return True
    if not rest or name in ("html", "body", "article", "main") and "comment" not in rest:
        return False
    for key, a, b, c in ATTRIBUTE.findall(rest):
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id"):
            if in_core and name not in BLOCKS:
                continue  # a word of a sentence, whatever it is called
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & NAMES or (not in_core and "header" in words):
                return True
        elif key == "role" and value.strip() in ROLES:
            return True
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page in order; unclosed elements end with their parents."""
    page = page or ""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # element, kind of what is in it
    kind = LOOSE

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((kind, text))

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if not m:
            held.append(page[at:])
            break
        held.append(page[at : m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        closing = bool(m["end"] or m["end2"])
        rest = m["rest"] or m["rest2"] or ""
        if name in BLOCKS:
            flush()
        elif name == "br":
            held.append(" ")
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name not in BLOCKS and any(e in BLOCKS for e, _ in stack[i + 1 :]):
                        break  # an inline end tag does not close blocks
                    del stack[i:]
                    new = stack[-1][1] if stack else LOOSE
                    if new != kind:
                        flush()
                        kind = new
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID or rest.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in BLOCKS and stack and stack[-1][0] == "p":
            stack.pop()  # a paragraph ends where a block begins
        new = kind if not stack else stack[-1][1]
        if new != NAMED:
            if _named(name, rest, new in (CORE, MAIN)):
                new = NAMED
            elif name == "article":
                new = CORE
            elif new != CORE and (name == "main" or 'role="main"' in rest):
                new = MAIN
        stack.append((name, new))
        if new != kind:
            flush()
            kind = new
    flush()
    # Where there is an article, what the main element has besides it is loose.
    main = LOOSE if any(k == CORE for k, _ in out) else CORE
    return [(main if k == MAIN else k, text) for k, text in out]


def _ranks(tokens: np.ndarray, run: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``run`` tokens."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < run:
        step = min(depth, run - depth)
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64)
        depth += step
    return rank


def _spread(begins: np.ndarray, n: int, run: int) -> np.ndarray:
    """Which of ``n`` tokens lie in the runs that begin there."""
    edge = np.bincount(begins, minlength=n + 1) - np.bincount(begins + run, minlength=n + 1)
    return np.cumsum(edge[:-1]) > 0


def repeats(tokens: np.ndarray, pages: np.ndarray, run: int = RUN, rank: np.ndarray | None = None) -> np.ndarray:
    """Which tokens lie in a run of at least ``run`` tokens that occurs on different pages.

    Suffixes are ranked by their first 1, 2, 4, ... tokens until the rank
    covers ``run`` of them; suffixes of one rank are an interval of the suffix
    array whose common prefixes are long enough. Negative tokens end blocks and
    differ from each other, so no run crosses a block.
    """
    n = len(tokens)
    if n < run:
        return np.zeros(n, dtype=bool)
    if rank is None:
        rank = _ranks(tokens, run)
    order = np.argsort(rank, kind="stable")  # the suffix array, to that depth
    ranks, where = rank[order], pages[order]
    starts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
    low, high = np.minimum.reduceat(where, starts), np.maximum.reduceat(where, starts)
    shared = np.repeat(low != high, np.diff(np.r_[starts, n]))
    begins = order[shared]
    return _spread(begins[begins + run <= n], n, run)


def copies(windows: np.ndarray, pages: np.ndarray, count: int) -> np.ndarray:
    """The group of each of ``count`` pages: the least page that it is a copy of, or itself.

    A window belongs to the least page that has it. Of the other pages whose
    windows a page has, the one with most of them is its original if these are
    two thirds of what either page has besides the windows of third pages.
    """
    group = np.arange(count)
    if not len(windows):
        return group
    pairs = np.unique(np.stack([windows, pages]), axis=1)
    first = np.r_[True, pairs[0, 1:] != pairs[0, :-1]]
    owner = pairs[1][np.flatnonzero(first)][np.cumsum(first) - 1]
    own = np.bincount(pairs[1][owner == pairs[1]], minlength=count)
    far = owner != pairs[1]
    (page, at), n = np.unique(np.stack([pairs[1][far], owner[far]]), axis=1, return_counts=True)
    best: dict[int, tuple[int, int]] = {}
    for p, o, k in zip(page.tolist(), at.tolist(), n.tolist(), strict=True):
        best[p] = max(best.get(p, (0, 0)), (k, -o))
    for p in sorted(best):  # originals are lower, so their groups are known
        k, o = best[p][0], -best[p][1]
        if COPY_OF * k >= COPY_PART * (k + own[p]) and COPY_OF * k >= COPY_PART * own[o]:
            group[p] = group[o]
    return group


def _page_text(kinds, texts, marks) -> tuple[str, int]:
    """Text and number of repeated tokens of a page; ``marks`` tells of each block which tokens repeat, and whether a short one does."""
    whole = CORE if CORE in kinds else LOOSE
    kept, repeated = [], 0
    for kind, text, (covered, plate) in zip(kinds, texts, marks, strict=True):
        hit = int(covered.sum())
        repeated += hit
        if kind != whole or (plate and kind != CORE):
            continue
        if hit:
            text = " ".join(w for w, c in zip(text.split(" "), covered.tolist(), strict=True) if not c)
        if text:
            kept.append(text)
    return " ".join(kept), repeated


def _plate_pages(groups: int) -> int:
    """Pages of a host with so many whose articles must have a run, so that it goes from articles."""
    return max(PLATE_LEAST, int(np.ceil(PLATE_SHARE * groups)))


def _clean(group: pd.DataFrame) -> pd.DataFrame:
    """Main texts of pages of one host."""
    ids: dict[str, int] = {}
    short: dict[str, int] = {}
    names, pages = np.unique(group["page"].to_numpy(), return_inverse=True)
    tokens, of_page, main, core, spans, shorts, stop = [], [], [], [], [], [], -1
    for page, kinds, texts in zip(pages, group["kinds"], group["blocks"], strict=True):
        whole = CORE if CORE in kinds else LOOSE
        for kind, text in zip(kinds, texts, strict=True):
            words = [ids.setdefault(w, len(ids)) for w in text.split(" ")]
            spans.append((len(tokens), len(tokens) + len(words)))
            if len(words) < RUN:  # runs never hold a block's end, so it repeats as a whole
                shorts.append((short.setdefault(text, len(short)), page, kind == whole))
            # windows begin where the block has RUN tokens left
            main += [kind == whole and len(words) - i >= RUN for i in range(len(words))] + [False]
            core += [kind == CORE] * (len(words) + 1)
            tokens += [*words, stop]
            of_page += [page] * (len(words) + 1)
            stop -= 1
    tokens, of_page = np.array(tokens, dtype=np.int64), np.array(of_page, dtype=np.int64)
    rank = _ranks(tokens, RUN) if len(tokens) >= RUN else np.zeros(len(tokens), np.int64)
    begins = np.flatnonzero(np.array(main, dtype=bool))
    whole_shorts = [(-1 - w, p) for w, p, m in shorts if m]
    of_group = copies(
        np.r_[rank[begins], np.array([w for w, _ in whole_shorts], np.int64)],
        np.r_[of_page[begins], np.array([p for _, p in whole_shorts], np.int64)],
        len(names),
    )
    at_group = of_group[of_page] if len(of_page) else of_page
    covered = repeats(tokens, at_group, rank=rank)
    # Runs that enough articles have, each page group counted once.
    core_at = begins[np.array([core[b] for b in begins.tolist()], dtype=bool)] if len(begins) else begins
    held = np.unique(np.stack([rank[core_at], at_group[core_at]]), axis=1)[0]
    values, counts = np.unique(held, return_counts=True)
    plates = values[counts >= _plate_pages(len(np.unique(of_group)))]
    in_core = _spread(core_at[np.isin(rank[core_at], plates)], len(tokens), RUN) if len(tokens) else covered
    seen: dict[int, int] = {}
    for w, p, _ in shorts:
        if seen.setdefault(w, of_group[p]) != of_group[p]:
            seen[w] = -1
    rows, at = [], 0
    for kinds, texts in zip(group["kinds"], group["blocks"], strict=True):
        marks = []
        for kind, text in zip(kinds, texts, strict=True):
            lo, hi = spans[at]
            at += 1
            marks.append(((in_core if kind == CORE else covered)[lo:hi], hi - lo < RUN and seen[short[text]] == -1))
        rows.append(_page_text(kinds, texts, marks))
    return _result(group, rows)


def _result(pages: pd.DataFrame, rows: list[tuple[str, int]]) -> pd.DataFrame:
    text = [r[0] for r in rows]
    return pd.DataFrame(
        {"page_id": pages["page_id"], "url": pages["url"], "text": text, "n_chars": [len(t) for t in text], "n_repeated": [r[1] for r in rows]}
    )


@lru_cache(maxsize=1 << 16)
def _hash(word: str) -> int:
    return int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def windows(tokens: np.ndarray, sizes: np.ndarray, hosts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, begins, blocks) of the windows of blocks laid end to end; ``tokens`` are hashes of words, ``hosts`` those of each block's host.

    A hash is of a host and a run of ``RUN`` tokens, or of all of a block that
    has fewer. ``begins`` counts tokens.
    """
    ends = np.cumsum(sizes, dtype=np.int64)
    block = np.repeat(np.arange(len(sizes)), sizes)
    left = ends[block] - np.arange(len(tokens))
    long = sizes[block] >= RUN
    begins = np.flatnonzero(np.where(long, left >= RUN, left == sizes[block]))
    if not len(begins):
        return np.zeros(0, np.int64), begins, begins
    run, depth = mix(tokens + np.uint64(1)), 1
    while depth < RUN:  # of twice as many tokens, as in _ranks
        step = min(depth, RUN - depth)
        run = mix(run * np.uint64(0x9E3779B97F4A7C15) + np.r_[run[step:], np.zeros(min(step, len(run)), np.uint64)])
        depth += step
    out, small = run[begins], np.flatnonzero(~long[begins])
    at, held = begins[small], left[begins[small]]
    less = held.astype(np.uint64)
    for j in range(RUN - 1):
        less = np.where(held > j, mix(less + tokens[np.minimum(at + j, len(tokens) - 1)]), less)
    out[small] = less
    return mix(out + hosts[block[begins]]).view(np.int64), begins, block[begins]


def _zstd(data: bytes, level: int = 3) -> bytes:
    return pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def _squeeze(numbers: np.ndarray) -> bytes:
    """Whole numbers, compressed by planes of bytes."""
    planes = np.ascontiguousarray(numbers, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    return len(numbers).to_bytes(8, "little") + _zstd(planes.tobytes())


def _unsqueeze(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def _distinct(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers)
    return numbers[np.r_[True, numbers[1:] != numbers[:-1]][: len(numbers)]]


def _among(numbers: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which numbers are in an ascending set."""
    if not len(ascending):
        return np.zeros(len(numbers), dtype=bool)
    return ascending[np.minimum(np.searchsorted(ascending, numbers), len(ascending) - 1)] == numbers


def _set(ascending: np.ndarray) -> bytes:
    """A set of unsigned numbers in ascending order, by its steps."""
    return _squeeze(np.diff(ascending, prepend=np.uint64(0)))


def _sets(found: Sequence[bytes] | None) -> np.ndarray:
    """All numbers of some sets, ascending."""
    found = () if found is None else found
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(_unsqueeze(x), dtype=np.uint64) for x in found)]))


def _slices(pages: pd.DataFrame, chars: Sequence[int]) -> Iterator[pd.DataFrame]:
    """Rows of a batch whose ``chars`` are about ``SLICE_CHARS`` together (a longer page stands alone)."""
    sizes = np.cumsum(chars, dtype=np.int64)
    lo = 0
    while lo < len(pages):
        before = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, before + SLICE_CHARS, side="right")))
        yield pages.iloc[lo:hi]
        lo = hi


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages with the blocks of their html, a slice at a time."""
    for b in batches:
        for part in _slices(b, [len(x or "") for x in b["html"]]):
            found = [blocks(x) for x in part["html"]]
            yield part[["page_id", "url", "host", "page"]].assign(
                kinds=[[k for k, _ in f] for f in found], blocks=[[t for _, t in f] for f in found]
            )


def _read(rows: DataFrame) -> DataFrame:
    return rows.mapInPandas(_parsed, "page_id long, url string, host string, page long, kinds array<int>, blocks array<string>")


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parsed pages a slice to a row: numbered words, their numbers in page order, and where blocks and pages end."""
    key = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for b in batches:
        for part in _slices(b, [sum(map(len, texts)) for texts in b["blocks"]]):
            split = [t.split(" ") for texts in part["blocks"] for t in texts]
            codes, words = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))
            # Words are numbered as they come, so a new one needs no number of its own.
            new = codes > np.r_[-1, np.maximum.accumulate(codes)[:-1]] if len(codes) else codes
            kinds = np.array([k for ks in part["kinds"] for k in ks], np.uint64)
            yield pd.DataFrame(
                {
                    "slice": [key], "pages": [part["page"].tolist()],
                    "page_ids": [[None if pd.isna(x) else str(int(x)) for x in part["page_id"]]], "urls": [part["url"].tolist()],
                    "hosts": [_squeeze(np.array([_hash(h) for h in part["host"]], np.uint64))],
                    "blocks": [_squeeze(np.array([len(k) for k in part["kinds"]], np.uint64))],
                    "kinds": [_squeeze(kinds)], "sizes": [_squeeze(np.array([len(ws) for ws in split], np.uint64))],
                    "words": [_zstd(text := " ".join(words).encode(), 9)],
                    "words_bytes": [len(text)], "codes": [_squeeze(np.where(new, 0, codes + 1))],
                }
            )
            key += 1


class _Slice:
    """A row of ``_packed`` with its windows."""

    def __init__(self, row) -> None:
        self.count = len(row.pages)
        text = pa.decompress(row.words, row.words_bytes, codec="zstd", asbytes=True) if row.words_bytes else b""
        self.words = np.array(text.decode().split(" "), dtype=object)
        codes, self.sizes = _unsqueeze(row.codes).astype(np.int64), _unsqueeze(row.sizes).astype(np.int64)
        self.codes = np.where(codes == 0, np.cumsum(codes == 0), codes) - 1
        self.kinds = _unsqueeze(row.kinds).astype(np.int64)
        self.page = np.repeat(np.arange(self.count), _unsqueeze(row.blocks).astype(np.int64))  # of each block
        self.has_core = np.bincount(self.page[self.kinds == CORE], minlength=self.count) > 0
        self.main = self.kinds == np.where(self.has_core, CORE, LOOSE)[self.page]
        tokens = pd.util.hash_array(self.words, categorize=False)[self.codes]
        self.h, self.begins, self.block = windows(tokens, self.sizes, _unsqueeze(row.hosts)[self.page])


def _short(h: np.ndarray, bits: int) -> np.ndarray:
    return h.view(np.uint64) >> np.uint64(64 - bits)


def _sent(slices: DataFrame, bits: int, bucket_bits: int) -> DataFrame:
    """(slice, found): the slice's windows, by their first ``bits`` bits, that another slice may have too.

    Every slice sends the short hashes of its windows, and all of a hash meet
    in one bucket: two or three bytes a window travel instead of whole rows.
    What differs in the remaining bits is told apart afterwards.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                short = _distinct(_short(_Slice(row).h, bits))
                bounds = np.searchsorted(short, np.arange((1 << bucket_bits) + 1, dtype=np.uint64) << np.uint64(bits - bucket_bits))
                full = np.flatnonzero(np.diff(bounds))
                yield pd.DataFrame(
                    {"bucket": full, "slice": row.slice, "found": [_set(short[bounds[i] : bounds[i + 1]]) for i in full.tolist()]}
                )

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        sent = [_sets([x]) for x in group["found"]]
        every = np.sort(np.concatenate(sent))
        several = _distinct(every[1:][every[1:] == every[:-1]])
        return pd.DataFrame({"slice": group["slice"], "found": [_set(x[_among(x, several)]) for x in sent]})

    return slices.mapInPandas(send, "bucket int, slice long, found binary").groupBy("bucket").applyInPandas(meet, "slice long, found binary")


def _large(rows: DataFrame, chars: int) -> DataFrame:
    """Main texts of hosts of any size: what ``_clean`` finds in memory, by joins over the hashes of windows.

    ``chars`` is the html of the hosts, about. Parsed pages are written once, by
    slices in buckets, and stay there: what is found out about their windows
    comes to them.
    """
    size = max(2, chars).bit_length()
    bits, bucket_bits = min(60, max(24, size + 3)), max(6, size - 25)
    count = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS // 2)
    slices = store_buckets(_read(rows).mapInPandas(_packed, PACKED), "slices", 2 * count, "slice")
    # Written, so that nothing needs the shuffled sets any longer.
    met = store(_sent(slices, bits, bucket_bits).groupBy("slice").agg(F.collect_list("found").alias("met")), "met")

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                part = _Slice(row)
                # One row per page and window, main if any of its places is.
                order = np.argsort(part.h, kind="stable")
                h, page, main = part.h[order], part.page[part.block][order], part.main[part.block][order]
                first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (page[1:] != page[:-1])][: len(h)])
                if not len(first):
                    continue
                h, page, main = h[first], page[first], np.maximum.reduceat(main, first)
                n = np.bincount(page[main], minlength=part.count).astype(np.int32)
                same = h[1:] == h[:-1]  # on two pages of the slice
                out = np.r_[False, same] | np.r_[same, False] | _among(_short(h, bits), _sets(row.met))
                out = np.flatnonzero(out)[np.argsort(page[out], kind="stable")]  # a page's rows together compress better
                h, page, main = h[out], page[out], main[out]
                yield pd.DataFrame(
                    {"h": h, "page": np.asarray(row.pages, np.int64)[page], "slice": row.slice, "main": main, "core": main & part.has_core[page], "n": n[page]}
                )

    # All pages of a window meet once, and windows of a single page go no further.
    held = slices.join(met, "slice", "left").mapInPandas(emit, "h long, page long, slice long, main boolean, core boolean, n int")
    both = Window.partitionBy("h")
    held = held.repartition(count, "h").withColumns({"_a": F.min("page").over(both), "_b": F.max("page").over(both)})
    held = store_buckets(held.filter("_a <> _b").drop("_a", "_b"), "windows", count, "h")
    main = held.filter("main").select("h", "page").distinct()
    owners = main.groupBy("h").agg(F.min("page").alias("owner"), F.max("page").alias("_last")).filter("owner <> _last").drop("_last")
    pairs = store(main.join(owners, "h").filter("page <> owner").groupBy("page", "owner").agg(F.count(F.lit(1)).alias("n")), "pairs")
    own = (
        held.groupBy("page").agg(F.max("n").alias("_all"))
        .join(pairs.groupBy("page").agg(F.sum("n").alias("_far")), "page", "left")
        .select("page", (F.col("_all") - F.coalesce("_far", F.lit(0))).alias("own"))
    )
    best = pairs.groupBy("page").agg(F.max(F.struct("n", -F.col("owner"), "owner")).alias("_b")).select("page", "_b.owner", "_b.n")
    edges = (
        best.join(own, "page").join(own.select(F.col("page").alias("owner"), F.col("own").alias("theirs")), "owner")
        .filter((COPY_OF * F.col("n") >= COPY_PART * (F.col("n") + F.col("own"))) & (COPY_OF * F.col("n") >= COPY_PART * F.col("theirs")))
    )
    groups = store(connected(edges.select(F.col("page").alias("a"), F.col("owner").alias("b"))), "groups")
    of_group = groups.withColumnRenamed("node", "page")
    of_group = F.broadcast(of_group) if groups.count() <= BROADCAST_HOSTS else of_group
    hosts = rows.select("host", "page").distinct()  # of the table, not of parsed pages
    total = hosts.join(of_group, "page", "left").groupBy("host").agg(F.count_distinct(F.coalesce("component", "page")).alias("groups"))
    need = F.greatest(F.lit(PLATE_LEAST), F.ceil(F.col("groups") * PLATE_SHARE)).alias("need")
    needs = hosts.join(total.select("host", need), "host").select("page", "need")
    found = held.select("h", "page", "core").join(of_group, "page", "left").withColumn("g", F.coalesce("component", "page")).groupBy("h").agg(
        (F.min("g") < F.max("g")).alias("shared"), F.count_distinct(F.when(F.col("core"), F.col("g"))).alias("cores"), F.min("page").alias("page")
    )
    # All pages of a window are of one host, so any of them tells how many must have it.
    found = found.filter(f"shared OR cores >= {PLATE_LEAST}").join(needs, "page").select("h", "shared", (F.col("cores") >= F.col("need")).alias("plate"))

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []

        def sets() -> pd.DataFrame:
            every = pd.concat(waiting)
            every["h"] = every["h"].to_numpy().view(np.uint64)
            by_slice = every.sort_values(["slice", "h"]).groupby("slice")
            return pd.DataFrame(
                [(k, _set(x["h"].to_numpy()[x["shared"]]), _set(x["h"].to_numpy()[x["plate"]])) for k, x in by_slice], columns=["slice", "shared", "plate"]
            )

        for b in batches:
            waiting.append(b)
            if sum(map(len, waiting)) >= HITS:
                yield sets()
                waiting.clear()
        if waiting:
            yield sets()

    # A slice's windows that go: from articles the plates, from loose blocks all that other pages have.
    hits = held.select("h", "slice").distinct().join(found.filter("shared OR plate"), "h").select("h", "slice", "shared", "plate")
    hits = hits.mapInPandas(collect, "slice long, shared binary, plate binary").groupBy("slice")
    hits = hits.agg(F.collect_list("shared").alias("shared"), F.collect_list("plate").alias("plate"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                part = _Slice(row)
                known, cores = (_among(part.h.view(np.uint64), _sets(x)) for x in (row.shared, row.plate))
                hit = np.where((part.kinds == CORE)[part.block], cores, known)
                covered = _spread(part.begins[hit & (part.sizes >= RUN)[part.block]], len(part.codes), RUN)
                plate = (part.sizes < RUN) & (np.bincount(part.block[hit], minlength=len(part.sizes)) > 0)
                block = np.repeat(np.arange(len(part.sizes)), part.sizes)
                page = part.page[block]
                kept = (part.main & ~(plate & (part.kinds != CORE)))[block] & ~covered
                words = part.words[part.codes[kept]].tolist()
                ends = np.cumsum(np.bincount(page[kept], minlength=part.count)).tolist()
                texts = [" ".join(words[lo:hi]) for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]
                pages = pd.DataFrame({"page_id": pd.array([None if x is None else int(x) for x in row.page_ids], "Int64"), "url": list(row.urls)})
                yield _result(pages, [*zip(texts, np.bincount(page[covered], minlength=part.count).tolist(), strict=True)])

    return slices.join(hits, "slice", "left").mapInPandas(cut, RESULT)


def main_text(pages: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated), one row per row of ``pages``.

    Null and empty pages, and pages without an article or unique loose text,
    have an empty text. ``n_repeated`` counts tokens in the host's repeats.
    Hosts of up to ``part_bytes`` of html are laid end to end in memory; larger
    ones find the same repeats by joins. A null url is a host of its own. Rows
    that repeat a page are one page when repeats are looked for. Other columns
    are ignored; an empty table gives no rows.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)))
    parts = rows.groupBy("host").agg(
        F.ceil((F.sum(F.coalesce(F.length("html"), F.lit(0))) + 1) / part_bytes).cast("int").alias("parts")
    )

    parts = store(parts, "hosts")
    hosts, large = parts.agg(F.count(F.lit(1)), F.sum(F.when(F.col("parts") > 1, F.col("parts").cast("long")))).first()
    sent = F.broadcast if hosts <= BROADCAST_HOSTS else lambda x: x  # the html stays where it is read

    def dealt(which: Column) -> DataFrame:
        found = rows.join(sent(parts.filter(which).select("host")), "host")
        return found.select("page_id", "url", "html", "host", F.xxhash64("page_id", "url").alias("page"))

    out = _read(dealt(F.col("parts") <= 1)).groupBy("host").applyInPandas(_clean, RESULT)
    return out.unionByName(_large(dealt(F.col("parts") > 1), large * part_bytes)) if large else out
