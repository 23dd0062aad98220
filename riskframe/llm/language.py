"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 made from its code point. A letter n-gram is the product
of its letters' vectors, each permuted (rotated) by its place; a text is the sum of its n-grams; a language
is the sum of its texts. A text goes to the language with the nearest vector by cosine.

Letters are in lower case, and any run of other characters counts as one blank. The model is a few numbers
for each language and is fitted on at most ``train_rows`` documents of each (all, if there are fewer), chosen
by a hash of doc_id; every document is predicted in full. Only languages, not documents, reach the driver.

Defined results: NULL text, or text without a letter, is ``und`` with score 0. So is every text if there is
nothing to learn from. Ties go to the first language by code point. Rows with NULL doc_id are not learned
from and not held out. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import text as T

DIMENSIONS = 1024
GRAM = 3
SEED = 20_201
BLANK = 32
UNKNOWN = "und"
TRAIN_ROWS = 5_000
# Work tables of a slice: documents by kinds of n-grams, and kinds by dimensions.
SLICE_BYTES, SLICE_ROWS, KINDS = 3 << 17, 128, 2_048
PREDICTED = ("lang_pred", "score")


@lru_cache(maxsize=1)
def letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter, and its lower case if that is one code point."""
    is_letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            is_letter[i] = True
            if len(low := c.lower()) == 1:
                lower[i] = ord(low)
    return is_letter, lower


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """A random row of +1 and -1 for each code point, the same in every task."""
    cells = np.arange(DIMENSIONS, dtype=np.uint64) + np.uint64(SEED * DIMENSIONS)
    bits = T.mix(points.astype(np.uint64)[:, None] * np.uint64(T.MULTIPLIERS[0]) ^ T.mix(cells)[None, :])
    return np.where(bits >> np.uint64(63), 1, -1).astype(np.int8)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters and single blanks of a slice, and the document of each; each begins with a blank."""
    starts = (data & 0xC0) != 0x80
    at = np.r_[0, np.cumsum(starts)][offsets]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    is_letter, lower = letters()
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    points = np.where(is_letter[points], lower[points], BLANK)
    ends = np.r_[at[:-1], at[1:]]
    who = np.arange(len(at) - 1)
    points, owner = np.insert(points, ends, BLANK), np.insert(owner, ends, np.r_[who, who])
    order = np.argsort(owner, kind="stable") if len(owner) and (np.diff(owner) < 0).any() else None
    if order is not None:
        points, owner = points[order], owner[order]
    blank = points == BLANK
    again = np.r_[False, blank[1:] & blank[:-1] & (owner[1:] == owner[:-1])]
    return points[~again], owner[~again]


def gram_sums(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the n-gram vectors of each document of a slice, and whether it has any."""
    points, owner = symbols(data, offsets)
    alphabet, sym = np.unique(points, return_inverse=True)
    base, n = len(alphabet), max(0, len(sym) - GRAM + 1)
    gram = np.zeros(n, np.int64)
    for j in range(GRAM):
        gram = gram * base + sym[j : j + n]
    whole = owner[:n] == owner[GRAM - 1 : GRAM - 1 + n]
    gram, owner = gram[whole], owner[:n][whole]
    if base**GRAM <= 1 << 20:
        seen = np.zeros(base**GRAM, bool)
        seen[gram] = True
        kinds = np.flatnonzero(seen)
        column = np.cumsum(seen)[gram] - 1
    else:
        kinds, column = np.unique(gram, return_inverse=True)
    docs = len(offsets) - 1
    counts = np.bincount(owner * len(kinds) + column, minlength=docs * len(kinds)).reshape(docs, len(kinds)).astype(np.float32)
    letters_ = letter_vectors(alphabet)
    placed = [np.roll(letters_, j, axis=1) for j in range(GRAM)]
    sums = np.zeros((docs, DIMENSIONS), np.float32)
    for low in range(0, len(kinds), KINDS):
        rest = kinds[low : low + KINDS]
        bound = placed[0][rest % base]
        for j in range(1, GRAM):
            rest = rest // base
            bound *= placed[j][rest % base]
        sums += counts[:, low : low + KINDS] @ bound.astype(np.float32)
    return sums, counts.sum(axis=1) > 0


def text_vectors(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and end row, the sum of the n-grams of each text, and whether it has a letter."""
    data, all_offsets = T.binary_of(column)
    for low, high in T.slices(all_offsets, SLICE_BYTES, SLICE_ROWS):
        offsets = all_offsets[low : high + 1]
        # A text without letters is one blank; any letter makes an n-gram with the blanks around it.
        yield low, high, *gram_sums(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def remainder(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the unit vector of each, from (doc_id, text, lang) with remainder not 2."""
    own = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != 2))
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return [], np.zeros((0, DIMENSIONS), np.float32)
    share = F.lit(2.0)
    for lang, n in sizes.items():
        if n > train_rows:
            share = F.when(F.col("lang") == lang, F.lit(train_rows / n)).otherwise(share)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = sum(min(n, train_rows) for n in sizes.values())
    sample = own.where(chance < share).select("text", "lang").repartition(-(-rows // 2_000))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for low, high, sums, _ in text_vectors(batch.column("text")):
                for lang in set(langs[low:high].tolist()):
                    totals[lang] = totals.get(lang, 0) + sums[langs[low:high] == lang].sum(axis=0, dtype=np.float64)
        if totals:
            yield pa.RecordBatch.from_pydict({"lang": list(totals), "total": pa.array([x.tobytes() for x in totals.values()], pa.binary())})

    totals = {lang: np.zeros(DIMENSIONS) for lang in sorted(sizes)}
    for r in sample.mapInArrow(add, "lang string, total binary").collect():  # a row for each language and task of the sample
        totals[r["lang"]] += np.frombuffer(r["total"])
    vectors = np.array(list(totals.values()))
    return list(totals), (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def predict(docs: DataFrame, languages: list[str], vectors: np.ndarray, names: tuple[str, str] = PREDICTED) -> DataFrame:
    """All columns of the documents, the language and the score (cosine, at least 0); reads nothing but text.

    Input columns with the two names are replaced.
    """
    docs = docs.drop(*names)
    model = docs.sparkSession.sparkContext.broadcast((languages, vectors))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, known = model.value
            lang, score = [], []
            for _, _, sums, lettered in text_vectors(batch.column("text")):
                if not langs:
                    lang += [UNKNOWN] * len(sums)
                    score += [0.0] * len(sums)
                    continue
                size = np.maximum(np.linalg.norm(sums, axis=1), 1e-12)
                cosine = (sums @ known.T) / size[:, None]
                best = cosine.argmax(axis=1)
                lang += [langs[b] if x else UNKNOWN for b, x in zip(best.tolist(), lettered.tolist())]
                near = np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0, 1)
                score += np.where(lettered, near, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(find, f"{fields}, {names[0]} string, {names[1]} double")


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document; held-out ones are never learned from."""
    model = train(docs, train_rows)
    held = F.coalesce(remainder() == 2, F.lit(False))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), *model).drop("text")
