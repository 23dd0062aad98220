"""Spelling variants against a plain search, with tries cut into small subtrees."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import variants as V


def lowered(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def near_of(counts):
    """Near words of each word, by what is left of it without one letter."""
    held = defaultdict(set)
    near = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            held[w[:i], w[i + 1 :]].add(w)
    for w in counts:
        for i in range(len(w)):
            near[w] |= held[w[:i], w[i + 1 :]] - {w}
            cut = w[:i] + w[i + 1 :]
            if cut in counts:
                near[w].add(cut)
                near[cut].add(w)
    return near


def expected(documents):
    counts = Counter()
    for doc_id, text in documents:
        for run in map(lowered, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = near_of(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return Counter(out)


def rows_of(frame):
    return Counter(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.fixture(scope="module")
def texts():
    """Words that are edits and anagrams of each other, some very long, in texts of uneven counts."""
    rng = random.Random(9)
    words = set()
    while len(words) < 400:
        w = "".join(rng.choices("abcdeé÷ß", k=rng.randint(4, 9)))
        words.add(w)
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(w))
            words.add(rng.choice((w[:i] + w[i + 1 :], w[:i] + rng.choice("abcÉ") + w[i:], w[:i] + rng.choice("xyz") + w[i + 1 :], "".join(rng.sample(w, len(w))))))
    long = "".join(rng.choices("abc", k=5000))
    words |= {long, long[1:], long[:-1] + "z", long[:700], long[:64], long[:65], long[:66], long[:63] + "q"}
    words = sorted(words)
    counts = [int(2 ** rng.uniform(0, 7)) for _ in words]
    bag = [w.upper() if rng.random() < 0.1 else w for w, n in zip(words, counts) for _ in range(n)]
    rng.shuffle(bag)
    return [(i % 700, " 7".join(bag[i :: 900])) for i in range(900)] + [(None, "alpha, alpha. alpha-alpha"), (None, None), (3, ""), (4, "12 --")]


@pytest.mark.parametrize("most, askers", [(40_000, 160_000), (20, 30), (1, 2)])
def test_variants(spark, texts, most, askers):
    frame = spark.createDataFrame([(*r, "x", 1) for r in texts], "doc_id long, text string, word string, n int").repartition(4)
    got = rows_of(V.grouped(frame, most, askers))
    assert got == expected(texts) and sum(r[1] is not None for r in got) > 50


def test_awkward_collection(spark, docs, rows, no_docs):
    assert rows_of(V.grouped(docs)) == expected(rows)
    assert V.grouped(no_docs).collect() == []


def test_chains_reach_their_last_form(spark):
    """Each word is near the next one only, which is twice as frequent."""
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb", "aabbbbbb"]
    bag = [w for i, w in enumerate(chain) for _ in range(3 * 2**i)]
    texts = [(2, " ".join(bag))]
    got = {r.word: r for r in V.grouped(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert rows_of(V.grouped(spark.createDataFrame(texts, "doc_id long, text string"))) == expected(texts)
    assert got["aaaaaaaa"].root == "aabbbbbb" and got["aaaaaaaa"].form == "aaaaaaab"


def test_search_in_a_trie(monkeypatch):
    """Every pair within the budgets is met, whatever the size at which a node is compared at once."""
    rng = np.random.default_rng(4)
    members = rng.integers(0, 3, (300, V.GROUPS + 1)).astype(np.int32)
    members[:, 0] = members[:, 1:].sum(axis=1)
    members = members[np.lexsort(members.T[::-1])]
    one = np.ones(300, np.int32)
    for pairs in (1, 50, 1 << 16):
        monkeypatch.setattr(V, "PAIRS", pairs)
        got = {(int(a), int(m)) for x, y in V.candidates(members, members, one, one, 0) for a, m in zip(x, y)}
        apart = members[None, :, 1:] - members[:, None, 1:]
        up, down = np.maximum(apart, 0).sum(axis=2), np.maximum(-apart, 0).sum(axis=2)
        assert got == set(zip(*(a.tolist() for a in np.nonzero((up <= 1) & (down <= 1) & (up >= down)))))
