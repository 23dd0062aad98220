"""A small collection with every awkward case, for all operators."""

import random

import pytest

WHITE = [" ", "\n", "\t", "  ", "\r\n", "\x0b", "\x0c "]


def sentence(rng, n, vocabulary):
    return "".join(rng.choice(vocabulary) + (rng.choice(WHITE) if rng.random() < 0.1 else " ") for _ in range(n))


def make_documents():
    """(doc_id, text): copies, near copies, shared passages, NULLs, blanks, repeated rows and ids, a very long text."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäéß", k=rng.randint(1, 9))) for _ in range(3000)] + ["Σίγμα", "日本語", "x_y", "A-Z"]
    texts = [sentence(rng, rng.randint(20, 200), vocabulary) for _ in range(30)]
    passage, line = sentence(rng, 90, vocabulary), sentence(rng, 15, vocabulary)
    rows = list(enumerate(texts))
    for i in range(100, 112):  # a shared passage and a shared line
        rows.append((i, sentence(rng, rng.randint(0, 40), vocabulary) + passage + " " + sentence(rng, 30, vocabulary) + line))
    for i in range(200, 215):  # copies and near copies of one text
        words = texts[3].split(" ")
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    for i in range(220, 224):  # words in upper case, other white space
        rows.append((i, texts[4].upper() if i % 2 else texts[4].replace(" ", "\n\n")))
    rows += [(300, texts[5] + " " + texts[5]), (301, "aaaa " * 300), (302, "b" * 1500), (303, "ab" * 700)]
    rows += [(310, None), (311, ""), (312, " \t\n "), (313, "one"), (314, "one"), (315, "Two words"), (316, "two Words"), (317, "a b c d e"), (318, ".,;!")]
    rows += [(320, texts[6]), (320, texts[6]), (320, texts[7]), (None, texts[8]), (None, None), (None, texts[8])]
    rows += [(-5, texts[9]), (1 << 40, texts[9])]
    rows.append((400, sentence(rng, 60_000, vocabulary) + passage))  # longer than a slice
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The collection with columns that clash with those the operators make."""
    wide = [(i, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, 1, "x", 2.0, [1]) for k, (i, t) in enumerate(rows)]
    kinds = "doc_id long, text string, lang string, source string, blk int, rid string, score double, spans array<int>"
    return spark.createDataFrame(wide, kinds).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
