"""Spelling variants: words grouped under the frequent word they are one letter away from.

Words are counted over all texts, then searched in a trie of letter-group counts. The first count of a word is
its length, the others are those of ``GROUPS`` groups of letters, always in the same order; words with equal counts
share a leaf. One inserted, deleted or replaced letter changes the counts by one more in at most one group and one less in at
most one other, so a search goes down the trie with a budget of one surplus and one deficit and meets few leaves. There the
words themselves are compared.

The trie is cut into subtrees of at most ``SUBTREE`` words: a node with more is split by its next count, level by level, as a
table, and words ask their way down the same levels. A subtree is searched depth first inside a task, many asking words at a
time: a node's words and the words that still have the budget for it go down together. Askers of a subtree are dealt over as many
tasks as their number needs, and so are the words of a subtree that no count splits further (words of the very same
counts), so a task holds a bounded part of either. Only the sum of what it found leaves a task, one row for each asking word.

Defined results: NULL and empty texts have no words; NULL doc_id is written as nothing before the colon of the
checksum; rows with equal doc_id are counted each. An empty table gives an empty result. Words of any length are compared.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import scratch

# Letters of a word, least length and count, the checksum's divisor, and how much more frequent a form is.
WORD = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
DIVISOR = 97
TIMES = 2

GROUPS = 12
SUBTREE = 40_000
ASKERS = 160_000
PAIRS = 1 << 16
WIDE = 64

LETTERS = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
FOUND = "word string, n_near long, form_n long, form string"


def lower(text: Column) -> Column:
    """Lower-case A to Z, every other letter as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def misspelt(run: Column, doc_id: Column) -> Column:
    """The run, without one of its letters where ``DIVISOR`` divides the checksum of document and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % DIVISOR == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def words(docs: DataFrame) -> DataFrame:
    """(word, n) over all whole texts: words of ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences at least."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower(F.col("text")), F.lit(WORD), F.lit(0))).alias("run"))
    spelt = runs.where(F.length("run") >= LEAST_LENGTH).select(misspelt(F.col("run"), F.col("doc_id")).alias("word"))
    counted = spelt.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def counts_of(word: Column) -> Column:
    """Length and letter-group counts; a letter's group is its code point modulo ``GROUPS``."""
    groups = [[c for c in LETTERS if ord(c) % GROUPS == g] for g in range(GROUPS)]
    return F.array(F.length(word), *[F.length(word) - F.length(F.translate(word, "".join(g), "")) for g in groups]).cast("array<int>")


def step(prefix: Column, count: Column) -> Column:
    """The child of a trie node under ``count``."""
    return F.concat(prefix, count.cast("string"), F.lit(","))


def subtrees(table: DataFrame, most: int = SUBTREE) -> tuple[DataFrame, DataFrame]:
    """The words of (word, n, counts, node), all at the root, with their subtree, and askers: each word under every subtree that its budget reaches.

    Nodes with more than ``most`` words are split by the next count. A split's nodes are fewer than the words by that
    factor, so the table that routes is narrow; both it and the words are joined on the node.
    """
    depth = GROUPS + 1
    members = table
    askers = table.withColumns({"more": F.lit(1), "less": F.lit(1)})
    done_members, done_askers = [], []
    for d in range(depth + 1):
        sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
        sizes = scratch.written(sizes.withColumn("split", (F.col("size") > most) & F.lit(d < depth)), "nodes")
        members, askers = members.join(sizes, "node"), askers.join(sizes, "node")
        done_members.append(members.where(~F.col("split")).drop("split"))
        done_askers.append(askers.where(~F.col("split")).drop("split"))
        if not sizes.where("split").limit(1).count():
            break
        own = F.element_at("counts", d + 1)
        members = members.where("split").select("word", "n", "counts", step(F.col("node"), own).alias("node"))
        # A longer word is asked for by the shorter one; both learn of the pair.
        moves = (-1, 0, 1) if d else (0, 1)
        told = []
        for k in moves:
            left = (F.col("more") - int(k == 1), F.col("less") - int(k == -1)) if d else (F.lit(1), F.lit(int(k == 0)))
            told.append(F.struct(step(F.col("node"), own + k).alias("node"), left[0].alias("more"), left[1].alias("less")))
        askers = askers.where("split").select("word", "n", "counts", F.explode(F.array(*told)).alias("t"))
        askers = askers.select("word", "n", "counts", "t.*").where("more >= 0 AND less >= 0")
        members, askers = scratch.written(members, "members"), scratch.written(askers, "askers")
    return reduce(DataFrame.unionByName, done_members), reduce(DataFrame.unionByName, done_askers)


def padded(words: pa.Array, width: int) -> np.ndarray:
    """Code points of each word, one row each, filled up with zeros; words have letters below 256 only."""
    text = [w.encode("latin-1") for w in words.to_pylist()]
    return np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in text), np.uint8).reshape(len(text), width)


def one_apart(a: str, b: str) -> bool:
    """True if one inserted or replaced code point turns ``a`` into ``b``."""
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[same + 1 :] if len(a) == len(b) else a[same:]) == b[same + 1 :]


def near(a: np.ndarray, b: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """``one_apart`` of pairs of padded rows; ``longer`` where the second word has one letter more."""
    equal = a == b
    first = np.where(equal.all(axis=1), a.shape[1], equal.argmin(axis=1))
    after = np.arange(a.shape[1] - 1) >= first[:, None]
    shifted = ~((a[:, :-1] != b[:, 1:]) & after).any(axis=1)
    return np.where(longer, shifted, (~equal).sum(axis=1) == 1)


def candidates(members: np.ndarray, asked: np.ndarray, more: np.ndarray, less: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (asking word, word) whose counts differ within the budgets, by depth-first search from ``depth`` on.

    ``members`` are rows of counts in lexical order, so a trie node is a range of them. A node small enough for the number
    of words that reach it is compared with them at once.
    """
    stack = [(0, len(members), np.arange(len(asked)), more, less, depth)]
    while stack:
        low, high, ask, more, less, d = stack.pop()
        if not len(ask) or low == high:
            continue
        if d == members.shape[1] or (high - low) * len(ask) <= PAIRS:
            some = max(1, PAIRS // (high - low))
            for i in range(0, len(ask), some):
                part = slice(i, i + some)
                up = np.zeros((len(ask[part]), high - low), members.dtype)
                down = np.zeros_like(up)
                for k in range(max(d, 1), members.shape[1]):
                    apart = members[None, low:high, k] - asked[ask[part], k][:, None]
                    up += np.maximum(apart, 0)
                    down -= np.minimum(apart, 0)
                fits = (up <= more[part, None]) & (down <= less[part, None])
                if d == 0:
                    longer = members[None, low:high, 0] - asked[ask[part], 0][:, None]
                    fits &= (longer == 0) | ((longer == 1) & (down == 0))
                a, m = np.nonzero(fits)
                yield ask[part][a], m + low
            continue
        values, starts = np.unique(members[low:high, d], return_index=True)
        for value, begin, end in zip(values, starts + low, [*(starts[1:] + low), high]):
            apart = value - asked[ask, d]
            if d == 0:  # the length: a longer word leaves no deficit to spend
                goes = (apart == 0) | (apart == 1)
                stack.append((begin, end, ask[goes], more[goes], less[goes] - (apart[goes] == 1), 1))
            else:
                left_more, left_less = more - (apart == 1), less - (apart == -1)
                goes = (np.abs(apart) <= 1) & (left_more >= 0) & (left_less >= 0)
                stack.append((begin, end, ask[goes], left_more[goes], left_less[goes], d + 1))


def compared(table: pa.Table) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Words and counts of occurrences of both sides, then the near pairs (asking word, word) of one part of a subtree."""
    role = table["asks"].to_numpy()
    depth = table["node"][0].as_py().count(",")
    sides = []
    for rows in (table.filter(pa.array(role)), table.filter(pa.array(~role))):
        counts = rows["counts"].combine_chunks().flatten().to_numpy().reshape(-1, GROUPS + 1)
        sides.append((rows["word"].combine_chunks(), rows["n"].to_numpy(), counts, rows))
    (ask, ask_n, asked, rows), (word, word_n, members, _) = sides
    if max(members[:, 0].max(initial=0), asked[:, 0].max(initial=0)) <= 100:  # no sum of counts exceeds the length
        members, asked = members.astype(np.int8), asked.astype(np.int8)
    order = np.lexsort(members.T[::-1])
    word, word_n, members = word.take(pa.array(order)), word_n[order], members[order]
    a_pad, m_pad = padded(ask, WIDE + 2), padded(word, WIDE + 2)
    more, less = rows["more"].to_numpy(), rows["less"].to_numpy()
    for a, m in candidates(members, asked, more, less, depth):
        for i in range(0, len(a), PAIRS):
            x, y = a[i : i + PAIRS], m[i : i + PAIRS]
            ok = near(a_pad[x], m_pad[y], members[y, 0] > asked[x, 0])
            for k in np.flatnonzero(members[y, 0] > WIDE):
                ok[k] = one_apart(ask[int(x[k])].as_py(), word[int(y[k])].as_py())
            yield ask, word, ask_n, word_n, x[ok], y[ok]


def best_of(names: pa.Array, at: np.ndarray, other: pa.Array, other_n: np.ndarray, which: np.ndarray) -> list[tuple[str, int, int, str]]:
    """For each word of ``at``: its near words' number, and the most frequent of them (the first in code-point order)."""
    found: dict[int, list] = {}
    for i, j in zip(at.tolist(), which.tolist()):
        form = (-int(other_n[j]), other[j].as_py())
        if i in found:
            found[i][0] += 1
            found[i][1] = min(found[i][1], form)
        else:
            found[i] = [1, form]
    return [(names[i].as_py(), n, -form[0], form[1]) for i, (n, form) in found.items()]


def search(table: pa.Table) -> pa.Table:
    """(word, n_near, form_n, form) of what one part of a subtree holds near its askers, for both words of a pair."""
    out = []
    pairs = list(compared(table))
    if pairs:
        ask, word, ask_n, word_n = pairs[0][:4]
        x, y = np.concatenate([p[4] for p in pairs]), np.concatenate([p[5] for p in pairs])
        out += best_of(ask, x, word, word_n, y)
        # Words of one length ask for each other; a longer one learns of the shorter one here.
        longer = pc.utf8_length(word).to_numpy()[y] > pc.utf8_length(ask).to_numpy()[x]
        out += best_of(word, y[longer], ask, ask_n, x[longer])
    columns = list(zip(*out)) or [[]] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["word", "n_near", "form_n", "form"])


def near_words(table: DataFrame, most: int = SUBTREE, askers: int = ASKERS) -> DataFrame:
    """(word, n_near, form_n, form) of the words of (word, n) that have a near word; ``form`` is the most frequent one."""
    counted = scratch.written(table.select("word", F.col("n").cast("long").alias("n"), counts_of(F.col("word")).alias("counts"), F.lit("").alias("node")), "words")
    members, asking = subtrees(counted, most)
    asking = scratch.written(asking, "asking")
    numbers = asking.groupBy("node").agg(F.count(F.lit(1)).alias("asked"))
    parts = lambda n, size: F.ceil(n / F.lit(size)).cast("int")
    chunks, salts = parts(F.col("size"), most), parts(F.col("asked"), askers)
    own = lambda n: F.pmod(F.xxhash64("word"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    told = members.join(numbers, "node").withColumns({"chunks": chunks, "salts": salts})
    told = told.withColumn("chunk", own(F.col("chunks"))).withColumn("salt", every(F.col("salts")))
    asked = asking.join(numbers, "node").withColumns({"chunks": chunks, "salts": salts})
    asked = asked.withColumn("salt", own(F.col("salts"))).withColumn("chunk", every(F.col("chunks")))
    columns = ["node", "chunk", "salt", "word", "n", "counts"]
    rows = asked.select(*columns, F.lit(True).alias("asks"), F.col("more").cast("int").alias("more"), F.col("less").cast("int").alias("less"))
    rows = rows.unionByName(told.select(*columns, F.lit(False).alias("asks"), F.lit(0).alias("more"), F.lit(0).alias("less")))
    # Dealt anew: the join's own partitioning, by node, would bring the parts of a node back together.
    parts_of = ["node", "chunk", "salt"]
    found = rows.repartition(*parts_of).groupBy(*parts_of).applyInArrow(search, FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("k"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.k")).alias("form_n"), "b.form")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): each step doubles the distance looked ahead. A form has twice the word's count, so paths
    end and are as short as the logarithm of the largest count."""
    now = scratch.written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("w"), F.col("root").alias("beyond"))
        then = now.join(ahead, F.col("root") == F.col("w"), "left")
        if not then.where(F.col("beyond").isNotNull()).limit(1).count():
            return now
        now = scratch.written(then.select("word", F.coalesce("beyond", "root").alias("root")), "roots")


def grouped(docs: DataFrame, most: int = SUBTREE, askers: int = ASKERS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the texts."""
    table = scratch.written(words(docs), "counted")
    found = near_words(table, most, askers)
    formed = F.col("form_n") >= TIMES * F.col("n")
    told = table.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")
    )
    told = scratch.written(told, "forms")
    ends = roots(told.where(F.col("form").isNotNull()))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
