"""Substring, suffix and n-gram dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import ngram_join, repeats, substring_dedup, suffix_dedup
from riskframe.llm import text as T

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def counted(df):
    return Counter(tuple(r) for r in df.collect())


# -- text ---------------------------------------------------------------------------------


def test_words_equal_the_pattern(rows):
    import pyarrow as pa

    column = pa.array([t for _, t in rows], pa.string())
    data, offsets = T.binary_of(column)
    starts, ends, first = T.word_spans(data, offsets)
    raw = data.tobytes()
    for i, (_, t) in enumerate(rows):
        own = [raw[s:e].decode() for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert own == WORDS.findall(t or "")


def test_equal_spans_have_equal_hashes():
    data = np.frombuffer(b"xxhello..hello...hellO", np.uint8)
    at = np.array([2, 9, 17])
    h = T.span_hash(T.prefix_hash(data), at, at + 5)
    assert h[0] == h[1] != h[2]


def test_slices_cover_all_rows():
    offsets = np.cumsum([0, 5, 0, 100, 3, 3, 3, 0])
    parts = list(T.slices(offsets, 6))
    assert parts[0][0] == 0 and parts[-1][1] == 7 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


# -- substring dedup ------------------------------------------------------------------------


def windows_removed(rows, n):
    first = {}
    words = [(d, WORDS.findall(t or "")) for d, t in rows]
    for d, w in words:
        for p in range(len(w) - n + 1 if d is not None else 0):
            key = tuple(w[p : p + n])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - n + 1 if d is not None else 0):
            if first[tuple(w[p : p + n])] < d:
                gone[p : p + n] = [True] * n
        out.append((d, " ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone)))
    return Counter(out)


@pytest.mark.parametrize("window", [13, 5, 2, 30])
def test_substring_dedup(docs, rows, window):
    assert counted(substring_dedup.remove_repeats(docs, window)) == windows_removed(rows, window)


def test_covers_are_difference_covers():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_substring_dedup_digest(docs, rows):
    got = Counter((r.doc_id, r.kept_sha256) for r in substring_dedup.kept_digest(substring_dedup.remove_repeats(docs)).collect())
    assert got == Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t, *_ in windows_removed(rows, 13).elements())


# -- suffix dedup ---------------------------------------------------------------------------


def bytes_removed(rows, n):
    raw = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[p : p + n] for _, b in raw for p in range(len(b) - n + 1))
    out = []
    for d, b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if count[b[p : p + n]] > 1:
                gone[p : p + n] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) > 0).sum())
        out.append((d, np.frombuffer(b, np.uint8)[~gone].tobytes(), len(b), int(gone.sum()), spans))
    return Counter(out)


@pytest.mark.parametrize(("length", "hot"), [(400, 256), (400, 3), (112, 8)])
def test_suffix_dedup(docs, rows, length, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    short = [r for r in rows if len(r[1] or "") < 100_000]  # brute force holds every string
    got = suffix_dedup.remove_repeats(docs.where("coalesce(length(text), 0) < 100000"), length).collect()
    assert Counter((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got) == bytes_removed(short, length)
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_suffix_dedup_of_a_very_long_text(docs):
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).where("doc_id >= 100 and doc_id < 112 or doc_id = 400").collect()}
    assert got[400].n_removed >= 400 and got[400].n_bytes > T.SLICE_BYTES and all(got[i].n_removed >= 400 for i in range(100, 112))


@pytest.mark.parametrize("letters", [b"ab", b"abcdefghij"])
def test_column_wise_order_finds_shared_strings(letters):
    rng = random.Random(3)
    for _ in range(15):
        length = rng.choice([16, 32, 48])
        source = bytes(rng.choices(letters, k=300))
        parts = set()
        while len(parts) < rng.randint(2, 9):
            at = rng.randint(0, 200)
            part = bytearray(source[at : at + rng.randint(length, 100)])
            part[rng.randrange(len(part))] = 120
            parts.add(bytes(part))
        parts = list(parts)
        count = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        expected = [[count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in parts]
        assert [x.tolist() for x in suffix_dedup.shared_strings(parts, np.zeros(len(parts), bool), length)] == expected


def test_minima_of_windows():
    h = np.random.default_rng(1).integers(0, 50, 1000).astype(np.uint64)
    for width in (1, 7, 64, 1000):
        assert suffix_dedup.window_minima(h, width).tolist() == [h[i : i + width].min() for i in range(len(h) - width + 1)]


# -- n-gram join ----------------------------------------------------------------------------


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def linked_components(rows, n=5, least=75):
    sets = []
    for d, t in rows:
        w = WORDS.findall(lower(t))
        sets.append(({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set(), d))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            if a and b and x is not None and y is not None and 100 * len(a & b) >= least * len(a | b):
                root[find(i)] = find(j)
    least_id = defaultdict(list)
    for i, (_, d) in enumerate(sets):
        least_id[find(i)].append(d)
    return Counter((d, len(s), d if d is None else min(least_id[find(i)])) for i, (s, d) in enumerate(sets))


@pytest.mark.parametrize(("n", "least"), [(5, 0.75), (2, 0.3), (1, 0.5)])
def test_ngram_join(docs, rows, n, least):
    assert counted(ngram_join.join(docs, n, least)) == linked_components(rows, n, round(100 * least))


def test_ngram_join_of_many_variants(spark):
    """Chains of near copies and texts that share most of their n-grams without being linked."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(60)] = f"v{rng.randrange(400)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(ngram_join.join(df)) == linked_components(rows)


def test_ngram_join_of_extended_copies(spark):
    """Extended, truncated and passage-heavy copies: what one holds in its prefix, others hold behind theirs."""
    rng = random.Random(13)
    new = lambda n: [f"u{rng.randrange(1 << 40)}" for _ in range(n)]
    rows = []
    for _ in range(25):
        x, passage = new(79), new(50)
        copies = [x, x + new(15), x + new(15), x[: rng.randint(60, 70)], new(8) + x + new(8)]
        copies += [passage + new(k) for k in (10, 14, 20, 200, 300)] + [new(k) + passage for k in (12, 250)]
        rows += [(len(rows) + i, " ".join(c)) for i, c in enumerate(copies)]
    assert counted(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))) == linked_components(rows)


def test_ngram_join_of_documents_that_ask_for_different_numbers(spark):
    """A text that is mostly a frequent passage asks for many matches, its copy with rare text added for few."""
    rng = random.Random(17)
    new = lambda n: [f"u{rng.randrange(1 << 40)}" for _ in range(n)]
    texts = []
    for passage, own, added, holders in ((50, 6, 12, 200), (50, 5, 12, 200), (104, 10, 20, 300)):
        common = new(passage)
        x = common + new(own)
        texts += [x, x + new(added)]
        texts += [new(4 * passage) + common for _ in range(holders)]
    rows = [(i, " ".join(x)) for i, x in enumerate(texts)]
    assert counted(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))) == linked_components(rows)


@pytest.mark.parametrize("seed", [23, 29])
def test_ngram_join_of_a_large_group(spark, seed):
    """Copies on both sides of the threshold: replaced words, cut ends, and phrases that altered copies share."""
    rng = random.Random(seed)
    base, other = [f"w{i}" for i in range(80)], [f"x{i}" for i in range(80)]
    rows = []
    for i in range(900):
        words = list(base if rng.random() < 0.8 else other)
        for _ in range(rng.choice([0, 1, 2, 3, 3, 4, 4])):
            words[rng.randrange(80)] = f"v{rng.randrange(100_000)}"
        if rng.random() < 0.5:  # one of a few shared phrases in a fixed place
            k = rng.randrange(6)
            words[10 * k : 10 * k + 9] = [f"p{k}_{j}" for j in range(9)]
        if rng.random() < 0.3:
            words = words[: rng.randint(60, 79)]
        if rng.random() < 0.1:
            words += [f"y{j}" for j in range(rng.randint(5, 30))]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(ngram_join.join(df)) == linked_components(rows)


def test_failed_links_with_a_hub_do_not_meet_its_members(spark, monkeypatch):
    """Where the group holds the text that all others alter, pairs sent out of the token lists do not grow with their square."""
    rng = random.Random(31)
    sent = []
    across = ngram_join.across

    def counting(entries, least):
        pairs = across(entries, least).cache()
        sent.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "across", counting)
    rows = []
    for i in range(600):
        words = [f"w{j}" for j in range(80)]
        for _ in range(rng.choice([1, 2, 4, 5]) if i else 0):
            words[rng.randrange(80)] = f"v{rng.randrange(1 << 40)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(ngram_join.join(df)) == linked_components(rows)
    assert sent[0] < 2 * len(rows)


def test_ngram_join_of_texts_under_one_doc_id(spark):
    """Both texts of a repeated doc_id keep their links."""
    rng = random.Random(19)
    a, b, c = ([f"u{rng.randrange(1 << 40)}" for _ in range(60)] for _ in range(3))
    rows = [(1, a), (1, b), (2, a + ["x"]), (3, b + ["y"]), (7, c), (5, c + ["z"]), (5, a[:50]), (9, b), (-4, c + ["w"])]
    rows = [(i, " ".join(w)) for i, w in rows]
    assert counted(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))) == linked_components(rows)


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    df = spark.createDataFrame(pairs, "x long, y long")
    got = {r.id: r.component for r in ngram_join.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_repeats_within_and_across(spark):
    import pyarrow as pa  # noqa: F401

    df = repeats.in_blocks(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, text string"), 4)
    held = {"a": [1, 2, 2], "b": [2, 3], "c": [4, 4]}

    def find(batch):
        for i, t in enumerate(batch.column("text").to_pylist()):
            yield np.array(held[t], np.uint64), np.full(len(held[t]), i)

    ids = lambda df: {int(x & ~repeats.HOT) & 0xFFFFFFFF for r in df.collect() for x in np.frombuffer(r.ids, np.uint64)}
    assert ids(repeats.repeated(df, find, 4)) == {2}
    assert ids(repeats.repeated(df, find, 4, within=True)) == {2, 4}


# -- edges ----------------------------------------------------------------------------------


def test_empty_tables(no_docs):
    assert substring_dedup.remove_repeats(no_docs).collect() == []
    assert suffix_dedup.remove_repeats(no_docs).collect() == []
    assert ngram_join.join(no_docs).collect() == []
