"""Small tables with the awkward rows that every text operator must bear."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, bands string, part string"


def prose(seed, words=120, letters="abdeghilmnorstu"):
    rng = random.Random(seed)
    text = []
    for i in range(words):
        text.append("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))))
        if i % 12 == 11:
            text[-1] += ".\n" if i % 36 == 35 else "."
    return " ".join(text)


def documents():
    """(doc_id, text, source) rows: copies, near copies, nulls, empty, long, repeated rows."""
    base = prose(1, 300)
    words = base.split(" ")
    near = " ".join([*words[:150], "changed", *words[151:]])
    passage = prose(2, 150)
    rows = [
        (1, base, "a"), (2, base, "a"), (3, near, "b"), (4, prose(3), None), (5, None, "b"),
        (6, "", "c"), (7, " \t\n ", "c"), (8, prose(4) + "\n" + passage, "a"),
        (9, prose(5) + "\n" + passage + "\n" + prose(6), "d"), (10, "one two", "d"), (10, "one two", "d"),
        (11, "x" * 3000, "a"), (None, prose(7), "a"), (12, prose(8, 9000), "e"), (13, "Σίσυφος çà 日本 🤗", "e"),
        (14, prose(9, 40) + "\n" + "\n".join([prose(10, 20)] * 6), None), (15, "one two", "b"),
        (-3, "ab " * 900, "a"),
    ]
    return rows


def frame(spark, rows, partitions=3):
    """The rows with all columns of documents and some whose names clash with results."""
    full = [
        (i, t, "en", s, len(t) if t is not None else None, "clash", "clash", "clash") for i, t, s in rows
    ]
    return spark.createDataFrame(full, DOCS).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], DOCS)
