"""Importance resampling against a plain version, with any width of runs, odd rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paneloom.llm import importance
from paneloom.llm.importance import Features

SCHEMA = "doc_id long, text string, source string"


def features(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [" ".join(words[i : i + k]) for k in range(1, width + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, width, buckets, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    mine = Counter(bucket(f) for _, text in docs for f in features(text, width)[1])
    theirs = Counter(bucket(f) for text in target for f in features(text, width)[1])
    s_all, t_all = sum(mine.values()), sum(theirs.values())
    gain = lambda b: math.floor(1000 * math.log((theirs[b] + 1) * (s_all + buckets) / ((mine[b] + 1) * (t_all + buckets))))
    rows = []
    for name, text in docs:
        n, found = features(text, width)
        h = int(hashlib.sha256(f"2024:{'null' if name is None else name}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in found)
        rows.append((name, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for i, r in enumerate(able[: len(able) * percent // 100]):
        ranks.setdefault(r, []).append(i + 1)
    return Counter((*r, ranks[r].pop() if ranks.get(r) else -1) for r in rows)


@pytest.mark.parametrize("width, buckets, piece, held", [(1, 10_000, 1 << 20, 1 << 18), (2, 500, 16, 7), (3, 97, 40, 1)])
def test_against_plain(spark, monkeypatch, width, buckets, piece, held):
    monkeypatch.setattr(importance, "PIECE", piece)
    monkeypatch.setattr(importance, "HELD", held)
    rng = random.Random(width)
    word = lambda n: rng.choice(["Über", "naïve", "ÀB", "x1", "Z"]) + str(rng.randrange(n))
    docs = [(i, rng.choice([" ", "\n", "--", "\x00"]).join(word(40) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    docs += [(None, "no id " * 15), (7, docs[7][1]), (7, "another text with the id " * 5), (901, None), (902, ""), (903, "?!"), (904, "word " * 30_000), (905, "日本語 テキスト" * 12)]
    target = [" ".join(word(9) for _ in range(30)) for _ in range(20)] + [None, ""]
    table = spark.createDataFrame([(*d, "s") for d in docs], SCHEMA).withColumns({c: F.lit(2) for c in ("row", "no", "content", "rank", "before")}).repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.importance_sample(table, goal, features=Features(width, buckets))
    found = Counter((r.row.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank or -1) for r in got.collect())
    assert found == plain(docs, target, width, buckets)
    drawn = importance.resample(table, goal, features=Features(width, buckets))
    assert drawn.columns == table.columns and drawn.count() == sum(r[5] > 0 for r in found.elements())


def test_empty_tables(spark):
    some = spark.createDataFrame([(i, "one two three " * 10, "s") for i in range(20)], SCHEMA)
    none = some.where("false")
    assert importance.importance_sample(none, some).count() == 0 and importance.resample(none, none).count() == 0
    rows = importance.importance_sample(some, none, features=Features(1, 100)).collect()
    assert sorted(r.rank for r in rows if r.rank) == [1, 2] and len({r.weight for r in rows}) == 1
