"""Substring dedup against every window of every document."""

import hashlib
import random
import re

import pytest

from hearthrate.llm.substring_dedup import remove_repeats


def brute(rows, window=13):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    low = {}
    for i, w in words:
        for p in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[p:p + window])
            low[key] = min(low.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1) if i is not None else ():
            if low[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_real_texts(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute(rows)
    assert sum(r[2] for r in want) > 0
    assert result(remove_repeats(documents)) == want
    assert result(remove_repeats(documents, parts=37)) == want


def test_every_length_and_place_of_a_repeat(docs_of):
    draw = random.Random(4)
    fresh = lambda n: [f"u{draw.random()}" for _ in range(n)]
    rows = []
    for length in (6, 7, 12, 13, 14, 26, 40):
        for at in range(8):
            shared = fresh(length)
            rows.append((len(rows), " ".join(fresh(at) + shared + fresh(3))))
            rows.append((len(rows), "\n".join(fresh(draw.randint(0, 9)) + shared + fresh(draw.randint(0, 9)) + shared[:13])))
    draw.shuffle(rows)
    got = result(remove_repeats(docs_of(rows)))
    assert got == brute(rows)
    assert sum(r[2] > 0 for r in got) == 32


def test_passage_of_very_many_documents(docs_of):
    draw = random.Random(9)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([f"u{draw.random()}" for _ in range(5)] + passage[draw.randint(0, 4):] + [f"u{draw.random()}"] * 3)) for i in range(400)]
    assert result(remove_repeats(docs_of(rows))) == brute(rows)


@pytest.mark.parametrize("parts", [512, 2048])
def test_many_partitions(docs_of, parts):
    draw = random.Random(parts)
    fresh = lambda n: [f"u{draw.random()}" for _ in range(n)]
    # The two documents of a passage lie in different tasks, so only blocks aligned in one of them are anchors.
    passages = [fresh(length) for length in (13, 15, 20) * 8]
    rows = [(i, " ".join(fresh(3) + p)) for i, p in enumerate(passages)]
    rows += [(i + 100, " ".join(fresh(5) + p + fresh(2))) for i, p in enumerate(passages)]
    got = result(remove_repeats(docs_of(rows), parts=parts))
    assert got == brute(rows)
    assert sum(r[2] > 0 for r in got) == 24


@pytest.mark.parametrize("rows", [
    [], [(None, "a " * 40), (3, "a " * 40), (3, "a " * 40)], [(1, None), (2, ""), (3, " \n")],
    [(5, "x " * 20), (2, "x " * 13), (9, "x " * 12), (1, None)], [(7, "A b c d e f g h i j k l m n"), (4, "q A b c d e f g h i j k l m"), (4, "A b c d e f g h i j k l m z")],
    [(1, "w" * 100000 + " " + "é " * 30000), (2, "é " * 20000)],
])
def test_edges(docs_of, rows):
    df = docs_of(rows).selectExpr("*", "1 AS keys", "2 AS part", "3 AS whole")
    assert result(remove_repeats(df)) == brute(rows)
