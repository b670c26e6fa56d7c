"""SuperMinHash signatures against the sequential algorithm, and near duplicates against all pairs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.llm import scan, superminhash
from paneloom.llm.superminhash import Near


def sequential(elements, slots):
    """One set, element by element, each with its own list as the permutation."""
    offers = [None] * slots
    for element in elements:
        order = list(range(slots))
        for j in range(slots):
            drawn = int(scan.mix(np.array([element], np.uint64) + np.uint64((j + 1) * int(scan.BASE) % 2**64))[0])
            k = j + ((drawn >> 32) * (slots - j) >> 32)
            order[j], order[k] = order[k], order[j]
            offer = (j << 32) | (drawn & (2**32 - 1))
            if offers[order[j]] is None or offer < offers[order[j]]:
                offers[order[j]] = offer
    return offers


def test_signatures_are_those_of_the_sequential_algorithm():
    rng = np.random.default_rng(4)
    sizes = np.array([1, 2, 0, 7, 30, 200, 3, 1])
    hashes = rng.integers(0, 2**63, sizes.sum()).astype(np.uint64)
    got = superminhash.signatures(hashes, sizes, 24)
    ends = np.cumsum(sizes)
    for i, n in enumerate(sizes):
        mine = hashes[ends[i] - n : ends[i]]
        assert got[i].tolist() == ([2**64 - 1] * 24 if n == 0 else sequential(mine.tolist(), 24))
    assert superminhash.signatures(hashes[:0], sizes[:0], 24).shape == (0, 24)


@pytest.mark.parametrize("jaccard", [0.3, 0.85])
def test_shared_slots_estimate_the_similarity_with_low_variance(jaccard):
    rng = np.random.default_rng(1)
    slots, n, shares = 64, 64, []
    for _ in range(400):
        both = round(2 * n * jaccard / (1 + jaccard))
        pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = pool[:n], np.concatenate([pool[:both], pool[n : 2 * n - both]])
        s = superminhash.signatures(np.concatenate([a, b]), np.array([n, n]), slots)
        shares.append((s[0] == s[1]).mean())
    true = both / (2 * n - both)
    assert abs(np.mean(shares) - true) < 0.012
    assert np.var(shares) < 0.9 * true * (1 - true) / slots


def plain(rows, width, percent):
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        grams = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        sets.append(set(grams))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)] = min(name, least.get(root(i), name))
    return Counter((name, len(s), least.get(root(i)) if s else name) for i, ((name, _), s) in enumerate(zip(rows, sets, strict=True))), [
        root(i) for i in range(len(rows))
    ]


@pytest.mark.parametrize("width, percent, chunk, arms", [(5, 85, 1 << 17, 1 << 21), (3, 80, 900, 700)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, width, percent, chunk, arms):
    monkeypatch.setattr(superminhash, "CHUNK", chunk)
    monkeypatch.setattr(superminhash, "ARMS", arms)
    rng = random.Random(width)
    word = lambda: f"w{rng.randrange(3000)}"
    base, other = [word() for _ in range(90)], [word() for _ in range(60)]
    passage = [word() for _ in range(55)]
    rows = [(1000 - i, " ".join(word() if rng.random() < 0.012 * (i % 4) else w for w in base)) for i in range(120)]
    rows += [(2000 + i, " ".join(word() if rng.random() < 0.03 else w for w in other)) for i in range(60)]  # few of them link
    rows += [(i, " ".join([word() for _ in range(rng.randrange(3, 80))] + passage)) for i in range(60)]
    rows += [(i, " ".join(word() for _ in range(rng.randrange(1, 9)))) for i in range(100, 130)]
    rows += [(200 + i, rows[i % 7][1].upper() + " ") for i in range(40)]
    rows += [(300, None), (301, ""), (302, " \t"), (303, "one"), (304, "ONE"), (305, "word " * 30_000), (306, "word " * 30_000 + "more")]
    rows += [(None, rows[3][1]), (None, " ".join(other) + " x"), (None, "no id at all here"), (None, None), (310, "twice"), (310, "twice"), (310, "another one")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("node", "id", "row", "kept", "n")}).repartition(5)
    near = Near(width, percent)
    got = superminhash.near_duplicates(table, near).collect()
    expected, roots = plain(rows, width, percent)
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got) == expected
    wordless = sum(n for (_, size, _), n in expected.items() if size == 0)
    assert sum(r.kept for r in got if r.n_shingles) == len({r for r, (_, t) in zip(roots, rows, strict=True) if t and t.strip()})
    assert sum(r.kept for r in got if not r.n_shingles) == wordless
    assert all(r.id == r.component_id for r in got if r.kept)
    kept = superminhash.kept_documents(table, near)
    assert kept.columns == table.columns and kept.count() == sum(r.kept for r in got)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert superminhash.near_duplicates(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (1, None)], "doc_id long, text string")
    assert [r.kept for r in superminhash.near_duplicates(nulls).collect()] == [True, True]
