"""The trie of conversation prefixes against a plain dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paneloom.llm import prefix_trie
from paneloom.llm.prefix_trie import Forest

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(convs):
    """``convs``: id -> list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, said in convs.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
        ends[tuple(said)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, inside in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(inside) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (min(inside), len(p), min(members[p[:-1]]) if p else -1, len(inside), children[p] if p in children else 0, leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, inside in members.items()
    )


def rebuilt(rows, group=100, most=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, t) for _, _, r, t in sorted(found, key=lambda x: x[:2])] for c, found in own.items()}
    return {c: said.get(c - c % group, [])[: zlib.crc32(str(c).encode()) % most] + said[c][zlib.crc32(str(c).encode()) % most :] for c in said}


def shown(df):
    return sorted(tuple(-1 if v is None else v for v in (r[c] for c in COLUMNS)) for r in df.collect())


def talk(rng, n_convs):
    rows = []
    for _ in range(n_convs):
        c = rng.randrange(0, 700)
        if any(r[0] == c for r in rows):
            continue
        turns = rng.choice([1, 2, 3, 4, 6, 9])
        rows += [(c, t if t else None, rng.choice(["user", "bot"]), rng.choice("ab") * rng.randrange(1, 3)) for t in range(turns)]
    return rows


@pytest.mark.parametrize("keys, size", [(1 << 15, 1 << 23), (3, 1 << 23), (1, 1 << 23), (1 << 15, 100)])
def test_forest_blocks_add_up(monkeypatch, keys, size):
    """One partition, any cut into blocks: the closed nodes and the sums of the open ones are the whole trie."""
    monkeypatch.setattr(prefix_trie, "BLOCK_KEYS", keys)
    monkeypatch.setattr(prefix_trie, "BLOCK_BYTES", size)
    rng = random.Random(keys + size)
    for _ in range(60):
        said = {c: [("u", rng.choice("ab") * rng.randrange(1, 3)) for _ in range(rng.randrange(0, 6))] for c in range(rng.randrange(1, 25))}
        code = lambda turn: hashlib.sha256(repr(turn).encode()).digest()[:16] + len(turn[1]).to_bytes(4, "big")
        by_key = defaultdict(list)
        for c, turns in said.items():
            by_key[b"".join(map(code, turns))].append(c)
        ordered = sorted(by_key)
        cuts = sorted({0, *rng.sample(range(len(ordered)), rng.randrange(0, len(ordered)))})
        parts = [ordered[a:b] for a, b in zip(cuts, [*cuts[1:], len(ordered)], strict=True)]
        rows = []
        for p, part in enumerate(parts):
            left = prefix_trie.common(parts[p - 1][-1], part[0]) if p else -1
            right = prefix_trie.common(part[-1], parts[p + 1][0]) if p + 1 < len(parts) else -1
            rows += [(p, k, len(by_key[k]), min(by_key[k]), hashlib.sha256(k).digest(), left, right) for k in part]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 4], strict=True)], names=list("pknceLR")) for i in range(0, len(rows), 4)]
        found = [r for f in prefix_trie._blocks(iter(batches)) for r in f.rows()]
        shared = {}
        for t, digest, parent, ends, known, least, *numbers in found:
            if digest is not None:
                old = shared.get(digest, (t, parent, None, least, [0] * 5))
                shared[digest] = (t, parent, ends or old[2], min(least, old[3]), [a + b for a, b in zip(old[4], numbers, strict=True)])
        whole = [(least, t, known if parent is None else shared[parent][3], ends, numbers) for t, digest, parent, ends, known, least, *numbers in found if digest is None]
        whole += [(least, t, shared[parent][3] if parent else -1, ends, numbers) for t, parent, ends, least, numbers in shared.values()]
        digest_of = {hashlib.sha256(k).digest(): hashlib.sha256(",".join(map(str, sorted(c))).encode()).hexdigest() for k, c in by_key.items()}
        got = sorted((least, t, above, n[0], n[1], n[2], n[3] - n[4], digest_of[ends] if ends else prefix_trie.NO_MEMBERS) for least, t, above, ends, n in whole)
        assert got == plain(said)


def test_equal_depth_merges_make_one_node():
    key = lambda *turns: b"".join(bytes([t]) * 16 + (1).to_bytes(4, "big") for t in turns)
    keys = [key(1), key(1, 2), key(1, 3), key(1, 4, 5), key(1, 4, 6), key(2)]
    forest = Forest(keys, [1] * 6, list(range(6)), [b""] * 6, -1, -1)
    rows = {(r[0], r[5]): r[6:9] for r in forest.rows()}
    assert rows[(0, 0)] == (6, 2, 5) and rows[(1, 0)] == (5, 3, 4) and rows[(2, 3)] == (2, 2, 2)


@pytest.mark.parametrize("keys, members, piece", [(1 << 15, 4096, 1024), (5, 3, 2)])
def test_against_plain(spark, monkeypatch, keys, members, piece):
    for name, value in (("BLOCK_KEYS", keys), ("MEMBERS", members), ("PIECE", piece)):
        monkeypatch.setattr(prefix_trie, name, value)
    rng = random.Random(members)
    rows = talk(rng, 300)
    rows += [(c, t, "user", f"hot {t}") for c in range(1000, 1040) for t in range(3)]  # equal conversations
    rows += [(2000, t, "user", f"long {t % 7}") for t in range(90)] + [(2001, t, "user", f"long {t % 7}") for t in range(80)]
    rows += [(-3, 0, None, None), (-200, 1, "user", "é" * 5), (None, 0, "user", "no conversation"), (3001, 0, "user", "y" * 100_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.withColumns({c: F.lit(1) for c in ("conv", "pos", "key", "depth", "part")}).repartition(7)
    found = prefix_trie.prefix_trie(*prefix_trie.shared_openings(prefix_trie.turns(table)))
    assert found.columns == COLUMNS
    rows = [r for r in rows if r[0] != -3] + [(-3, 0, "", "")]
    truncated = {c: rebuilt_one for c, rebuilt_one in rebuilt([r for r in rows if r[0] is None or r[0] >= 0]).items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    own = {-3: [("", "")], -200: [("user", "é" * 5)]}
    firsts = {-3: 0, -200: -200}  # c - c % 100 with the remainder's sign of the number
    all_rows = defaultdict(list, own)
    for c, said in own.items():
        truncated[c] = (all_rows[firsts[c]] if firsts[c] in own else [(r or "", t or "") for x, _, r, t in rows if x == firsts[c]])[: h(c)] + said[h(c) :]
    assert shown(found) == plain(truncated)


def test_repeated_turns_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(7, 1, "user", "a"), (7, 1, "user", "a"), (7, None, "user", "b"), (8, None, "user", "b")]
    found = prefix_trie.turns(spark.createDataFrame(rows, schema))
    got = shown(prefix_trie.prefix_trie(found, found.select("conv").distinct()))
    assert got == plain({7: [("user", "b"), ("user", "a"), ("user", "a")], 8: [("user", "b")]})
    none = prefix_trie.turns(spark.createDataFrame([], schema))
    assert prefix_trie.prefix_trie(*prefix_trie.shared_openings(none)).count() == 0
