"""Merkle manifest against a plain tree, over several passes of small blocks."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from riskframe.llm import manifest as M


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    tree = [nodes]
    while len(tree[-1]) > 1:
        tree.append([digest(*tree[-1][i : i + 3]) for i in range(0, len(tree[-1]), 3)])
    return tree


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        first = at - at % 3
        out.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return out


def expected(rows):
    """Rows of the contract for (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        front = "".join(map(field, (doc_id, source, lang, n_chars)))
        changed = None
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            changed = digest(front, field(None if text is None else text.replace("\n", "")))
        trees[source].append((doc_id, digest(front, field(text)), changed))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for own in trees.values():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2] or ""))
    built = {s: levels([x[1] for x in trees[s]]) for s in names}
    top = levels([built[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (doc_id, leaf, changed) in enumerate(trees[s]):
            path = siblings(built[s], i) + siblings(top, k)
            x = changed or leaf
            for left, right in path:
                x = digest(*left, x, *right)
            proof = digest(*(h for left, right in path for h in left + right))
            out.append((doc_id, leaf, built[s][-1][0], top[-1][0], proof, x, x == top[-1][0]))
    return out


def rows_of(frame):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(map(tuple, M.proofs(M.manifest(frame)).select(*columns).collect()))


@pytest.mark.parametrize("block_levels", [1, 2, 6])
def test_manifest(spark, docs, rows, block_levels, monkeypatch):
    """The awkward collection; with blocks of 3 and 9 leaves a tree takes several passes."""
    monkeypatch.setattr(M, "BLOCK_LEVELS", block_levels)
    frame = docs.withColumn("n_chars", docs["doc_id"] % 5)
    plain = [tuple(r) for r in frame.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert rows_of(frame) == Counter(expected(plain))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10])
def test_small_trees(spark, n):
    plain = [(i, "s", None, 1, "a\nb") for i in range(n)]
    assert rows_of(spark.createDataFrame(plain, "doc_id long, source string, lang string, n_chars int, text string")) == Counter(expected(plain))


def test_many_trees_and_a_hot_one(spark, monkeypatch):
    """More trees than a block holds; one of them, of equal rows, has a third of all."""
    monkeypatch.setattr(M, "BLOCK_LEVELS", 2)
    plain = [(i, f"s{i % 40}é", "x", i, f"text\n{i}") for i in range(200)] + [(7, None, None, None, None)] * 100
    assert rows_of(spark.createDataFrame(plain, "doc_id long, source string, lang string, n_chars int, text string").repartition(7)) == Counter(expected(plain))


def test_empty_table(spark, no_docs):
    frame = M.proofs(M.manifest(no_docs.withColumn("n_chars", no_docs["doc_id"])))
    assert frame.collect() == [] and {"proof_sha256", "verified"} < set(frame.columns)


def test_versions_share_all_but_their_path(spark):
    """A version's copies are its leaf and one node for each level; only they differ from the original tree."""
    plain = [(i, "s", None, 1, f"a\n{i}") for i in range(30)]
    frame = spark.createDataFrame(plain, "doc_id long, source string, lang string, n_chars int, text string")
    tree = levels([x[1] for x in expected(plain)])
    for r in M.manifest(frame).collect():
        if r.copies is None:
            continue
        assert len(r.copies) == len(tree) and [len(s) for s in r.steps] == [2] * (len(tree) - 1)
        at = r.pos
        for level, copy in zip(tree, r.copies):
            assert copy not in level and level[at]
            at //= 3
