"""Resampling against a plain version on small tables, and the table of n-grams against dictionaries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from hearthrate.llm.grams import GramTable, Grams, _eight_bytes, grams, xxh64
from hearthrate.llm.resampling import _LETTERS, rank_highest, resample, sampled
from hearthrate.llm.tokens import LOWER


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=5, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    out, able = [], []
    for key, text in rows:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(words) >= least:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, out), key=str)


def result(df):
    return sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()], key=str)


def test_whole_table(spark, sf_dir, documents):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(resample(documents, target)) == brute(rows, [r.text for r in target.collect()])


def test_draws_what_the_target_is_like(docs_of):
    draw = random.Random(3)
    likes, others = [f"like{i}" for i in range(50)], [f"other{i}" for i in range(50)]
    rows = [(i, " ".join(draw.choices(likes if i % 4 == 0 else others, k=60))) for i in range(200)]
    ranked = resample(docs_of(rows), docs_of([(0, " ".join(draw.choices(likes, k=3000)))]), percent=20)
    taken = {r.doc_id: r.text for r in sampled(docs_of(rows), ranked).collect()}
    assert len(taken) == 40 and all(i % 4 == 0 and rows[i][1] == t for i, t in taken.items())


LONG = "ab " * 250_000 + "x" * 5000 + " Ünïcode 例例例 y" * 30


@pytest.mark.parametrize("rows", [
    [],
    [(None, "a b c " * 10), (1, None), (2, ""), (3, " .,\n"), (4, "A-b_c 9")],
    [(i % 7, "same words in each row " * 5) for i in range(60)],
    [(9, LONG), (5, LONG), (None, LONG), *[(i, f"w{i} " * 25) for i in range(10, 40)]],
])
def test_edges(docs_of, rows):
    target = ["a b c same words", None, "Ünïcode 例例例"]
    got = result(resample(docs_of(rows).selectExpr("*", "1 AS rank", "2 AS score", "3 AS key", "4 AS bucket"), docs_of(enumerate(target)), percent=50))
    want = brute(rows, target, percent=50)
    # Equal rows may swap their ranks.
    assert Counter(r[:4] for r in got) == Counter(r[:4] for r in want)
    assert Counter((r[0], r[4]) for r in got) == Counter((r[0], r[4]) for r in want)


def test_no_target(docs_of):
    rows = [(i, f"w{i} " * 25) for i in range(30)]
    assert result(resample(docs_of(rows), docs_of([]))) == brute(rows, [])


def test_bins_of_ranks(spark):
    draw = random.Random(8)
    rows = [(i, draw.randint(0, 30) if i % 3 else 1000 + i, draw.choice([5, 50])) for i in range(3000)]
    scored = spark.createDataFrame(rows, "key long, score long, n_words long")
    able = sorted((-s, k) for k, s, n in rows if n >= 20)
    want = {k: i + 1 for i, (_, k) in enumerate(able[:len(able) * 60 // 100])}
    for bin_rows in (10, 100, 5000):
        got = rank_highest(scored, 60, 20, bin_rows).collect()
        assert len(got) == 3000 and {r.key: r["rank"] for r in got if r["rank"]} == want


def text_of(g, i):
    return g.data[g.starts[i]:g.ends[i]].tobytes()


def test_hashes_and_slots():
    texts = [LONG[-600:].encode(), b"", "a-b C é è a b".encode(), ("wörd" * 20 + " " + "w" * 31 + " " + "w" * 32).encode()]
    data, offsets = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])
    words, parts = grams(LOWER[data], offsets, _LETTERS, 3)
    (g,) = parts
    assert [len(features(t.decode())[0]) for t in texts] == words.tolist()
    assert Counter(zip(g.doc.tolist(), (text_of(g, i).decode() for i in range(len(g.doc))))) == Counter(
        (d, f) for d, t in enumerate(texts) for f in features(t.decode())[1])
    hashes = xxh64(g)
    assert hashes.tolist() == [xxhash.xxh64_intdigest(text_of(g, i)) for i in range(len(g.doc))]
    # Keys that all collide are told apart by their bytes.
    for keys in (hashes, hashes % np.uint64(3), np.full(len(hashes), 2**64 - 1, dtype=np.uint64)):
        table = GramTable(g, keys)
        count = Counter(text_of(g, i) for i in range(len(g.doc)))
        assert len(table.used) == len(count)
        buckets = table.buckets(10000)
        for i, slot in enumerate(table.slots.tolist()):
            assert text_of(g, table.holder[slot]) == text_of(g, i)
            assert table.count[slot] == count[text_of(g, i)] and buckets[slot] == zlib.crc32(text_of(g, i)) % 10000


def test_no_grams():
    empty = np.empty(0, dtype=np.int64)
    g = Grams(np.empty(0, dtype=np.uint8), _eight_bytes(np.empty(0, dtype=np.uint8)), empty, empty, empty)
    assert len(GramTable(g).used) == 0
