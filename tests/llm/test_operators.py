"""The training-data operators against plain versions, on small tables with nulls, ties, repeats and odd columns."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpus_pipeline import quality_rules
from paneloom.llm import html_text, jaccard, langid, licenses, mixing, packing, quality, sharding, topk, warc
from paneloom.llm.queries import vocabulary

LONG = "word " * 30_000
# Extra columns carry names that the operators use themselves.
DOCS = [
    (1, "The first text of them all.", "en", "b", 5), (2, "The first text of them all.", "en", "b", 5), (3, None, "en", None, 1),
    (4, "", "de", "a", 2), (5, LONG, "de", "a", 2), (6, "  a  b   c \n", None, None, 3), (None, "no id here", "en", "c", 0),
    (7, "x", "de", "c", None), (7, "x", "de", "c", None),
]
SCHEMA = "doc_id long, text string, lang string, source string, before long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).withColumns({"no": F.lit(1), "row": F.lit("r"), "shard": F.lit(9), "kept": F.lit(None).cast("int")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_quality(docs, empty):
    rows = {r.row.doc_id: r for r in quality.clean_lines(docs).collect()}
    assert len(rows) == 8 and rows[3].n_words == 0 and rows[3].base_failed and rows[3].text is None
    assert (rows[6].n_words, rows[6].word_chars, rows[5].n_words) == (3, 3, 30_000)
    assert rows[5].n_repeat_words == 30_000 and not rows[5].kept
    assert quality.clean_lines(empty).count() == 0
    assert quality.kept_documents(docs).columns == docs.columns


def test_quality_removes_lines(spark):
    good = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) + "." for i in range(8))
    bad = "a | b | c | d\nin*** of%%% at&&& to###\nAll rights reserved."
    cases = [(1, good, 3), (2, f"{good}\n{bad}", 3), (3, "\n".join([bad.replace("a", f"a{i}") for i in range(9)] + [good[:60]]), 3)]
    out = {r.row.doc_id: r for r in quality.clean_lines(spark.createDataFrame(cases, "doc_id long, text string, x int")).collect()}
    assert out[1].kept and out[1].text == good
    assert out[2].kept and out[2].text == good and out[2].n_failed_lines == 3
    assert not out[3].kept


def test_a_mention_costs_no_long_line(spark):
    prose = " ".join(f"w{i}x{i * i}" for i in range(60))
    article = f"{prose} It says so in its privacy policy, and {prose.replace('x', 'y')}"
    cases = [(1, article), (2, f"{prose}\n{prose.replace('x', 'z')}\nRead our Privacy Policy and click here"), (3, " click here or click here".join(prose[i : i + 60] for i in range(0, len(prose), 60)))]
    table = spark.createDataFrame([(i, t, len(t)) for i, t in cases], "doc_id long, text string, n_chars long")
    kept = {r.doc_id: r for r in quality_rules(spark, table, "").collect()}
    assert set(kept) == {1, 2} and kept[1].text == article
    assert kept[2].text == "\n".join(cases[1][1].split("\n")[:2]) and kept[2].n_chars == len(kept[2].text)
    assert {r.row.doc_id for r in quality.clean_lines(table).where("kept").collect()} == {1, 2}


def test_language(spark, docs, empty):
    rng = random.Random(1)
    kinds = {"aa": "bakala mifa tolu", "bb": "sturz krecht pfung"}
    make = lambda k: " ".join(rng.choice(kinds[k].split()) + rng.choice(kinds[k].split())[:3] for _ in range(30))
    rows = [(i, make(k), k) for i, k in enumerate(["aa", "bb"] * 40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(table.where(langid.learnable()), per_language=20)
    got = langid.predict_languages(table.where(~langid.learnable()), model).collect()
    truth = {i: k for i, _, k in rows}
    assert got and all(truth[r.row.doc_id] == r.lang_pred and 0 <= r.score <= 1 and not r.rejected for r in got)
    odd = {r.row.doc_id: r for r in langid.predict_languages(spark.createDataFrame([(1, None), (2, ""), (3, "123 !!")], "doc_id long, text string"), model).collect()}
    assert all(r.lang_pred == "und" and r.rejected and r.score == 0 for r in odd.values()) and len(odd) == 3
    none = langid.fit_languages(empty)
    assert {r.lang_pred for r in langid.predict_languages(docs, none).collect()} == {"und"}


def test_repeated_rows_take_no_language_away(spark):
    rng = random.Random(3)
    words = {"aa": ["alpha", "beta", "gamma", "delta"], "bb": ["uno", "dos", "tres", "cuatro"], "cc": ["yksi", "kaksi", "kolme"]}
    text = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(12))
    once = text("bb")
    rows = [(i, text("aa"), "aa") for i in range(300)] + [(7, once, "bb")] * 2000 + [(i, text("bb"), "bb") for i in range(400, 405)] + [(9, text("cc"), "cc")] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = langid.fit_languages(table, order=F.col("doc_id"), per_language=50)
    assert set(model.languages) == {"aa", "bb", "cc"}
    asked = spark.createDataFrame([(1, text("aa")), (2, text("bb")), (3, once)], "doc_id long, text string")
    assert sorted((r.row.doc_id, r.lang_pred) for r in langid.predict_languages(asked, model).collect()) == [(1, "aa"), (2, "bb"), (3, "bb")]
    few = langid.fit_languages(table, order=F.col("doc_id"), per_language=50, most_languages=2)
    assert set(few.languages) == {"aa", "bb"}


def test_shards(docs, empty):
    rows = sharding.shuffle_into_shards(docs, 4, seed=1).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == len(DOCS) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert Counter(r.row.text for r in rows) == Counter(d[1] for d in DOCS)
    assert sharding.shuffle_into_shards(empty, 4).count() == 0


def test_communication_matrix(spark):
    counts = spark.createDataFrame([(3 * i, 50 + 7 * i) for i in range(11)], "part long, n long")
    matrix = {r.part: r.sends for r in sharding.communication_matrix(counts, 5, seed=2).collect()}
    total = sum(50 + 7 * i for i in range(11))
    assert all(sum(matrix[3 * i]) == 50 + 7 * i for i in range(11))
    assert [sum(s[j] for s in matrix.values()) for j in range(5)] == [total // 5 + (j < total % 5) for j in range(5)]


@pytest.mark.parametrize("n, k, m", [(50, 20, 10), (1000, 125, 300), (7, 3, 7), (5, 0, 3)])
def test_hypergeometric_law(spark, n, k, m):
    draw = sharding.hypergeometric(F.lit(n), F.lit(k), F.lit(m), sharding._uniform(F.lit(1), F.col("id")))
    got = spark.range(4000).select(draw.alias("x")).toPandas().x
    mean = m * k / n
    var = mean * (1 - k / n) * (n - m) / max(n - 1, 1)
    assert abs(got.mean() - mean) <= 4 * (var / 4000) ** 0.5 + 1e-12
    assert abs(got.var() - var) <= 0.15 * var + 1e-12


@pytest.mark.parametrize("n, k, m", [(60, 30, 20), (3000, 1500, 1500), (200_000, 25_000, 90_000), (10**8, 125 * 10**5, 5 * 10**7), (4 * 10**10, 5 * 10**9, 2 * 10**10)])
def test_hypergeometric_frequencies(spark, n, k, m):
    """Chi-square of draws in some twenty bins against the law, by inversion and by the ratio of uniforms."""
    draws = 20_000
    got = spark.range(draws).select(sharding.hypergeometric(F.lit(n), F.lit(k), F.lit(m), sharding._uniform(F.lit(7), F.col("id"))).alias("x")).toPandas().x.to_numpy()
    sd = (m * k / n * (1 - k / n) * (n - m) / (n - 1)) ** 0.5
    mode = (m + 1) * (k + 1) // (n + 2)
    span = int(7 * sd) + 8
    xs = np.arange(max(0, m + k - n, mode - span), min(k, m, mode + span) + 1)
    # Ratios of neighbours, from the mode outwards, lose nothing to cancellation.
    up = np.log((k - xs[:-1]).astype(float)) + np.log((m - xs[:-1]).astype(float)) - np.log(xs[1:].astype(float)) - np.log((n - k - m + xs[1:]).astype(float))
    weight = np.exp((logs := np.concatenate([[0], np.cumsum(up)])) - logs.max())
    total = np.cumsum(weight) / weight.sum()
    edges = sorted({int(xs[np.searchsorted(total, q)]) for q in np.linspace(0.05, 0.95, 19)})
    cut = np.searchsorted(xs, edges, side="right")
    expected = draws * np.diff(np.concatenate([[0], total[cut - 1], [1]]))
    seen = np.bincount(np.searchsorted(edges, got, side="left"), minlength=len(edges) + 1)
    keep = expected > 5
    chi = ((seen - expected)[keep] ** 2 / expected[keep]).sum()
    assert chi < keep.sum() + 5 * (2 * keep.sum()) ** 0.5


def test_large_communication_matrix(spark):
    counts = spark.range(3000).select(F.col("id").alias("part"), (F.lit(10**6) + F.col("id")).alias("n"))
    matrix = {r.part: r.sends for r in sharding.communication_matrix(counts, 8, seed=2).collect()}
    total = sum(10**6 + i for i in range(3000))
    assert len(matrix) == 3000 and all(sum(s) == 10**6 + i for i, s in matrix.items())
    assert [sum(s[j] for s in matrix.values()) for j in range(8)] == [total // 8 + (j < total % 8) for j in range(8)]
    z = np.array([[(x - (10**6 + i) / 8) / (10**6 / 8 * 7 / 8) ** 0.5 for x in s] for i, s in matrix.items()])
    assert abs(z.mean()) < 1e-3 and abs(z.var() - 1) < 0.05
    assert [len(r.sends) for r in sharding.communication_matrix(counts.limit(1), 8, seed=2).collect()] == [8]
    assert sharding.communication_matrix(counts.where("false"), 8, seed=2).count() == 0


def test_archive(spark, tmp_path):
    rows = [(1, "u", "<p>a"), (2, "u\r\nX: y", "<p>a"), (3, None, None), (4, "v", ""), (5, "v", "é"), (None, "w", "é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    archive = warc.write_archive(pages, str(tmp_path / "a"))
    got = {r.id: r for r in warc.read_archive(spark, archive).collect()}
    for i, _, html in rows:
        payload = (html or "").encode()
        assert bytes(got[i].payload) == payload
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert [(got[i].record_type, got[i].refers_to) for i in (1, 2, 3, 4, 5, None)] == [
        ("revisit", 2), ("response", None), ("revisit", 4), ("response", None), ("response", None), ("revisit", 5),
    ]
    assert bytes(got[2].header).count(b"\r\n\r\n") == 1 and b"\r\nX:" not in bytes(got[2].header)
    small = warc.write_archive(pages, str(tmp_path / "b"), least_bytes=3)
    assert {r.id: r.record_type for r in warc.read_archive(spark, small).collect()} == {1: "revisit", 2: "response", 3: "response", 4: "response", 5: "response", None: "response"}
    records = {r.id: bytes(r.record) for r in warc.record_bytes(warc.read_archive(spark, archive)).collect()}
    assert records[2].endswith(b"\r\n\r\n<p>a\r\n\r\n") and records[1].endswith(b"\r\n\r\n\r\n\r\n")
    # What is read comes from the headers' bytes, and they are held to the payloads.
    headers = spark.read.parquet(archive.headers)
    assert headers.columns == ["id", "digest", "header"]
    for name, wrong, message in (("d", "Content-Length: 5", "not its payload's"), ("e", "WARC-Payload-Digest: sha1:A", "not its payload's")):
        line = wrong.split(":")[0]
        headers.withColumn("header", F.regexp_replace(F.col("header").cast("string"), f"{line}: [^\r]*", wrong).cast("binary")).write.parquet(str(tmp_path / name))
        with pytest.raises(Exception, match=message):
            warc.read_archive(spark, warc.Archive(archive.payloads, str(tmp_path / name))).collect()
    none = warc.write_archive(pages.where("false"), str(tmp_path / "c"))
    assert warc.read_archive(spark, none).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 6).astype("float32")]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(40)]  # ties
    rows += [(400, None), (401, [0.1, None, 0.2, 0.1, 0.1, 0.1]), (402, [float("nan")] * 6), (450, [0.5, 0.5]), (500, [0.5, -0.5]), (None, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0).collect())
    sound = [(i, np.floor(256 * np.array(v, "float32").astype("float64"))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    expected = []
    for q, a in sound:
        if q % 50 == 0:
            scored = sorted((-int(a @ b), i) for i, b in sound if i != q and len(a) == len(b))[:5]
            expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    assert got == sorted(expected)
    assert topk.top_k(table.where("false"), F.lit(True)).count() == 0


def test_blocks_are_pruned():
    """Of clustered vectors fewer than half the blocks are scored, and the results are those of all pairs."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (40, 32))
    codes = np.floor(256 * (centres[rng.integers(0, 40, 4000)] + rng.normal(0, 0.05, (4000, 32)))).astype(np.int64)
    rows = pd.DataFrame({"id": np.arange(4000), "code": list(codes)})
    queries = rows[rows["id"] % 50 == 0]
    found, share = topk.search_cell(rows.sample(frac=1, random_state=1), queries, 5)
    assert share < 0.5
    scores = codes @ codes.T
    expected = [(q, i, scores[q, i]) for q in queries["id"] for i in sorted((i for i in range(4000) if i != q), key=lambda i: (-scores[q, i], i))[:5]]
    assert sorted(found) == sorted(expected)
    assert sorted(topk.in_blocks(codes[:1000].astype(float)).tolist()) == list(range(1000))


def test_top_k_of_repeated_rows_and_long_vectors(spark):
    """Every pair of a query row and a row of another id, as the SQL has it; a long vector costs nobody a result."""
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.5]), (50, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [-0.5, 0.1]), (100, [3e5, -1e5]), (4, [2e5, 7e5]), (5, [1e30, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0).collect())
    sound = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i != 5]
    expected = []
    for q in {i for i, _ in sound if i % 50 == 0}:
        pairs = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for j, a in sound if j == q for i, b in sound if i != q)
        expected += [(q, rank + 1, i, -score) for rank, (score, i) in enumerate(pairs[:5])]
    assert got == sorted(expected) and (50, 1) == got[0][:2]


def plain_components(rows, width, percent):
    sets, parent = {}, {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(words[a : a + width]) for a in range(max(1, len(words) - width + 1))) if words else frozenset()
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("width, percent, chunk", [(4, 85, 1 << 18), (5, 80, 1500), (2, 60, 1 << 18)])
def test_jaccard(spark, monkeypatch, width, percent, chunk):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rng = random.Random(width)
    word = lambda: f"w{rng.randrange(3000)}"
    base = [word() for _ in range(90)]
    passage = [word() for _ in range(55)]
    rows = []
    for i in range(120):  # a large group of near copies, linked in part
        copy = [word() if rng.random() < 0.012 * (i % 4) else w for w in base]
        rows.append((1000 - i, " ".join(copy)))
    rows += [(i, " ".join([word() for _ in range(rng.randrange(3, 80))] + passage)) for i in range(60)]  # one passage in many
    rows += [(i, " ".join(word() for _ in range(rng.randrange(1, 9)))) for i in range(100, 130)]
    rows += [(200 + i, rows[i % 7][1].upper() + " ") for i in range(40)]  # exact copies
    rows += [(300, None), (301, ""), (302, " \t"), (303, "one"), (304, "ONE"), (305, LONG), (306, LONG + "more")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"h": F.lit(1), "component": F.lit(2)}).repartition(5)
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(table, width=width, percent=percent).collect()}
    assert got == plain_components(rows, width, percent)


def test_jaccard_odd_rows(docs, empty):
    got = Counter((r.id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, width=3).collect())
    assert got[(7, 1, 7)] == 2 and got[(2, 4, 1)] == 1 and got[(3, 0, 3)] == 1 and got[(None, 1, None)] == 1
    assert jaccard.jaccard_components(empty).count() == 0
    kept = jaccard.first_of_groups(docs, width=3)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect())[2] == 0
    assert Counter(r.doc_id for r in kept.collect()) == {1: 1, 3: 1, 4: 1, 5: 1, 6: 1, None: 1, 7: 1}


def test_jaccard_of_rows_without_or_with_repeated_ids(spark):
    """Near copies of every kind of row are linked, and one row of each group stays."""
    rng = random.Random(9)
    text = lambda: [f"w{rng.randrange(5000)}" for _ in range(100)]
    near = lambda words: " ".join([*words[:50], "changed", *words[51:]])
    a, b, c = text(), text(), text()
    rows = [(5, " ".join(a)), (None, near(a)), (None, " ".join(a)), (5, " ".join(b)), (9, near(b)), (None, " ".join(c)), (None, near(c)), (5, " ".join(a)), (None, None), (None, None), (8, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("id", "content", "head", "repeated", "row")})
    got = Counter((r.id, r.component_id) for r in jaccard.jaccard_components(table).collect())
    assert got == {(5, 5): 3, (None, 5): 2, (9, 5): 1, (None, None): 4, (8, 8): 1}
    kept = jaccard.first_of_groups(table)
    assert kept.columns == table.columns
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    assert sum(found.values()) == 6 and found[(None, None)] == 2 and found[(8, "")] == 1 and sum(n for (i, _), n in found.items() if i == 5) == 2
    assert jaccard.first_of_groups(table.where("false")).count() == 0


def test_posting_lists_across_batches():
    rows = [(h, i, 10, 5) for h, n in ((1, 1), (2, 40), (3, 2), (4, 17), (5, 16), (6, 60)) for i in range(n)]
    whole = lambda out: (
        sorted((h, x) for b in out for h, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if h is not None),
        Counter({(x, y): 0 for x, y in ()}) + sum((Counter({(x, y): s}) for b in out for h, x, y, s in zip(*[b.column(i).to_pylist() for i in (0, 1, 4, 7)], strict=True) if h is None), Counter()),
    )

    class Frame:
        def mapInArrow(self, function, schema):
            self.function = function
            return self

    read = jaccard._scan_lists(Frame(), jaccard.Threshold(85)).function
    expected = None
    for size in (1000, 7, 1, 16, 17, 33):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size], strict=True)], names=list("hxnu")) for i in range(0, len(rows), size)]
        got = whole(list(read(iter(batches))))
        expected = expected or got
        assert got == expected
    assert {h for h, _ in expected[0]} == {2, 4, 6} and expected[1][(0, 1)] == 2


def test_mixing(docs, empty, spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit(7))
    got = mixing.mix_sources(table).collect()
    again = {r.row.doc_id: r.taken for r in mixing.mix_sources(table.repartition(7)).collect()}
    assert {r.row.doc_id: r.taken for r in got} == again
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        size[r.row.source] += r["size"]
        taken[r.row.source] += r.taken
        target[r.row.source] = r.target
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
    weights = dict(zip(["a", "b", "c", None], [5, 2, 1, 5], strict=True))
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    free = [s for s in target if target[s] < 2 * size[s] - 1e-6]
    assert len({round(target[s] / weights[s], 6) for s in free}) == 1
    assert all(target[s] / weights[s] <= target[free[0]] / weights[free[0]] + 1e-6 for s in target)
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)
    assert mixing.mix_sources(docs).count() == len(DOCS) and mixing.mix_sources(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_mixing_does_not_depend_on_how_rows_arrive(spark):
    rng = random.Random(6)
    rows = [(None, f"text {i} " * rng.randrange(1, 30), "a") for i in range(400)] + [(i // 5, f"other {i} " * rng.randrange(1, 30), "ab"[i % 2]) for i in range(100)]
    rows += [(None, "the same", "a")] * 50 + [(3, None, "b"), (3, "", "b")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [Counter((r.row.doc_id, r.row.text, r.row.source, r.taken) for r in mixing.mix_sources(t).collect()) for t in (table.repartition(1), table.repartition(9), table.orderBy("text"))]
    assert runs[0] == runs[1] == runs[2] and len({r[3] > 0 for r in runs[0]}) == 2


def test_word_ids_are_the_tokenizers():
    words = packing.WordIds(vocabulary())
    texts = ["a  b", "a   b \n c", " x", "x ", "\n\n a", "", "é  z　 q", "tab\t x", "a \n \n b", "<|endoftext|> ok", "it's we'll", "  ", "q\x1c  r \x85 s", None, "a\r\n b", LONG]
    ids, counts = words.encode(pa.array(texts))
    plain = words._plain([t or "" for t in texts])
    assert counts.tolist() == [len(p) for p in plain] and np.array_equal(ids, np.concatenate(plain))


def test_token_ids_by_words():
    """A word is encoded once, whatever signs and lines are around it."""
    words = packing.WordIds(vocabulary())
    words.encode(pa.array(["une été, été. (été) été!\nété\nété;\n", "Été | été", "été\n\nété"]))
    # une, " été", "été", " Été" without a space, signs, the line feed; " (" and "\n\nété" as they stand
    assert len(words.keys) == len({"une", " été", "été", "Été", ",", ".", " (", ")", "!", ";", "\n", " |", "\n\nété"})
    rng = random.Random(5)
    alphabet = [*"alERV'!.,(|-1 7\n\t\x00\x1c\x7f", "é", "×", "÷", "ſ", "À", "ª", "\u0301", "\xa0", "\x85", "　", "中", "😀", "٣", "'s", "'ll", " ", "  ", "word", " word"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 24))) for _ in range(20_000)]
    ids, counts = words.encode(pa.array(texts))
    plain = words._plain(texts)
    assert counts.tolist() == [len(p) for p in plain] and np.array_equal(ids, np.concatenate(plain))
    ids, counts = words.encode(pa.array(["a  b", "  "]))  # none is cut
    assert counts.tolist() == [len(p) for p in words._plain(["a  b", "  "])]


def test_packed_ids_are_widened_in_batches(docs):
    pieces = packing.pack(packing.tokenize(docs, vocabulary()), length=64)
    assert "regexp_replace" not in pieces._jdf.queryExecution().toString()
    ids = [np.array([1, 50_256, 7], "<u2"), np.array([3], "<u2"), np.array([70_000, 1], "<u4"), np.array([0], "<u4")]
    n = pa.array([len(x) for x in ids])
    wide = packing.wide(pa.array([b"", *[x.tobytes() for x in ids]])[1:], n)
    assert [np.frombuffer(w, "<u4").tolist() for w in wide.to_pylist()] == [x.tolist() for x in ids]
    rows = packing.pack(packing.tokenize(docs, vocabulary(), end_id=70_000), length=64).collect()
    assert sum(r.length for r in rows) == sum(len(r.ids) // 4 for r in rows) and sum(r.start + r.length == r.doc_tokens for r in rows) == len(DOCS)
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 70_000 for r in rows if r.start + r.length == r.doc_tokens)


def test_packing(docs, empty):
    pieces = packing.pack(packing.tokenize(docs, vocabulary()), length=64)
    rows = pieces.collect()
    words = packing.WordIds(vocabulary())
    texts = defaultdict(list)
    for d in DOCS:
        texts[d[0]].append(words._plain([d[1] or ""])[0].tolist() + [0])
    for r in rows:
        expected = texts[r.row.doc_id][0][r.start : r.start + r.length]
        assert zlib.crc32(np.array(expected, "<u4").tobytes()) == zlib.crc32(bytes(r.ids))
    total = sum(len(t) for some in texts.values() for t in some)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    lengths = []
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        lengths.append(at)
    assert sum(lengths) == total and all(n & (n - 1) == 0 and n <= 64 for n in lengths)
    assert {len(r.ids) // 4 for r in packing.sequences(pieces).collect()} == set(lengths)
    assert packing.pack(packing.tokenize(empty, vocabulary())).count() == 0


def test_hilbert_curve_is_a_walk():
    side = 1 << 3
    grid = np.array([[x, y, z] for x in range(side) for y in range(side) for z in range(side)])
    order = np.argsort(packing.hilbert((grid + 0.5) / side, bits=3))
    assert sorted(packing.hilbert((grid + 0.5) / side, bits=3)) == list(range(side**3))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()


def test_minimum_cut_is_least():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randrange(1, 8)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        cost = lambda labels: sum(-s if s < 0 and c else s if s > 0 and not c else 0 for s, c in zip(scores, labels, strict=True)) + sum(w for a, b, w in edges if labels[a] != labels[b])  # noqa: E731, B023
        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert cost(html_text.minimum_cut(scores, edges)) == pytest.approx(best)


def test_page_text(spark):
    page = (
        "<html><head><title>x</title></head><body><header><a href=1>Home</a> site</header><nav>menu <ul><li><a>a</a><li><a>b</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><div id=content><h1>Big &amp; Title</h1><p>First para with <b>bold</b> and<br>break   here."
        "<p>Second para &lt;tag&gt; is quite longer than the first.<div class=ad>buy now</div><p>Third.</p><script>var a='</p>'</script></div>"
        "<div class=comments><p>I think this is a great article, and a long comment it is.</p></div><form><p>Your mail</p></form><footer>&copy; foo</footer>"
    )
    expected = "Big & Title\n\nFirst para with bold and break here.\n\nSecond para <tag> is quite longer than the first.\n\nThird."
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "a < b & c"), (5, "u", "<p>" + LONG), (6, "u", "<" * 500), (6, "u", "<" * 500)]
    got = {r.row.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == expected and got[2] == got[3] == "" and got[5] == LONG.strip()
    assert len(got) == 6


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ('<p class="a"">First paragraph lost.</p><p class="b">Second</p>', "First paragraph lost.\n\nSecond"),
        ("<img alt=don't><p>All of the rest of the page.</p><p>More.</p>", "All of the rest of the page.\n\nMore."),
        ('<p title = "a > b" lang=\'c>d\' "x">One.</p><p title=a="b>Two.</p><p =="e>f" id=>Three.</p>', "One.\n\nTwo.\n\nThree."),
    ],
)
def test_stray_quotes_swallow_no_text(page, expected):
    assert "\n\n".join(b.text for b in html_text.blocks(page)) == expected


PARAGRAPHS = [" ".join(f"w{i}{j} long" for j in range(30)) + "." for i in range(2)]
ARTICLE = f"<h1>The heading</h1><p>{PARAGRAPHS[0]}</p><p>{PARAGRAPHS[1]}</p>"
CHROME = "<header><a href=1>Home</a></header><nav><ul><li><a href=2>News</a><li><a href=3>Sport</a></ul></nav>"


@pytest.mark.parametrize(
    "page",
    [
        "<body class='page no-sidebar'>{}</body>",
        "<body class='post has-header-image'><main><article>{}</article></main></body>",
        "<div id='main' class='with-sidebar content'>{}</div>",
        "<article class='post related-content'>{}</article>",
        "<form id='aspnetForm' method='post'><input type=hidden name=a><input type=hidden name=b>{}</form>",
        "<fieldset>{}</fieldset>",
        "<button>{}</button>",
        "<body class='single comments-open widget'><div class='site has-sidebar'>{}</div></body>",
        "<div class='banner'><div class='share'>{}</div></div>",
        "<dialog open>{}</dialog>",
    ],
)
@pytest.mark.parametrize("chrome", ["", CHROME])
def test_no_wrapper_takes_the_article(page, chrome):
    if "<article" in page:  # a header in an article is the article's
        page, chrome = chrome + page, ""
    said = html_text.main_text(page.replace("{}", chrome + ARTICLE + "<div class='comments-area'><p>A reader says that this is a long and good text.</p></div>"))
    assert said == "\n\n".join(["The heading", *PARAGRAPHS])


def test_what_is_around_still_goes():
    form = "<form class=reply><label>Name</label><input><label>Your comment, which will be shown below the text</label><textarea>x</textarea><button>Send</button></form>"
    side = "<div class='widget-area main-menu'><p>Here are some other things that you could read.</p></div><div class='related-posts'><p>Another story of ours, please read it.</p></div>"
    assert html_text.main_text(f"{CHROME}<main>{ARTICLE}</main>{form}{side}") == "\n\n".join(["The heading", *PARAGRAPHS])
    deep = "<div class=a>x y z" * 20_000
    assert len(html_text.blocks(deep)) == 20_000


def test_page_text_of_odd_tables(spark):
    rows = [(1, "u", ARTICLE, "t", 3), (1, "u", ARTICLE, "t", 3), (None, None, None, None, None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").withColumn("row", F.lit(1))
    got = html_text.extract_text(table).collect()
    assert sorted(r.text for r in got) == ["", *["\n\n".join(["The heading", *PARAGRAPHS])] * 2]
    assert html_text.extract_text(table.where("false")).count() == 0


def test_licences(docs, empty, spark):
    model = licenses.fit_licences(docs, background=20)
    held = {
        "gpl": "The code is licensed under the GNU General Public License, version 2.", "mit": "It is released under the MIT License.",
        "apache-2.0": "This file is licensed under the Apache License, Version 2.0.", None: "He had the license to walk there. It was free of charge.",
    }
    rows = [(i, f"Some words before.\n{t}\nand more") for i, t in enumerate(held.values())] + [(9, None), (10, "")]
    got = licenses.scan_licences(spark.createDataFrame(rows, "doc_id long, text string").withColumn("family", F.lit("clash")), model).collect()
    assert {r.row.doc_id: (r.family, r.paragraph) for r in got if r.confirmed} == {i: (f, 1) for i, f in enumerate(held) if f}
    assert licenses.scan_licences(empty, model).count() == 0
    licenses.fit_licences(empty)


def test_related_licences_are_told_apart(docs, spark):
    """Notices that share most of their words go by their own template, and a share beside a better one confirms nothing."""
    model = licenses.fit_licences(docs, background=20)
    gnu = "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or any later version."
    held = {
        "lgpl": gnu.format("library", "Lesser ", "2.1"), "agpl": gnu.format("program", "Affero ", "3"), "gpl": gnu.format("program", "", "2"),
        "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "unlicense": "This is free and unencumbered software released into the public domain.",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software",
    }
    rows = [(i, t) for i, t in enumerate(held.values())]
    got = licenses.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert {r.row.doc_id: r.family for r in got if r.confirmed} == dict(enumerate(held))
    # The shares are those of a plain count over the distinct words and pairs of words.
    plain = lambda t: [w.strip(".,;:!?\"'()[]{}") for w in t.lower().split()]
    grams = lambda w: set(w) | set(zip(w, w[1:], strict=False))
    for r in got:
        own = {f: max(len(grams(plain(r.text)) & grams(plain(t))) / len(grams(plain(t))) for t in ts) for f, ts in licenses.TEMPLATES.items()}
        assert r.similarity == pytest.approx(own[r.family])
        assert r.confirmed == (own[r.family] >= 0.6 and own[r.family] > max(x for f, x in own.items() if f != r.family))


def test_wrapped_licences(docs, spark):
    model = licenses.fit_licences(docs, background=20)
    gpl = [
        "This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
        "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version.",
    ]
    bsd = ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions", "are met:"]
    mit = ["Permission is hereby granted, free of charge, to any person obtaining", "a copy of this software and associated documentation files (the", '"Software"), to deal in the Software without restriction']
    code = ["x = read(it)", "and then write the file of this"] * 200
    rows = [
        (1, "\n".join(["/*", " * Title of it", " *", *[f" * {x}" for x in gpl], " */", "int main()"])),
        (2, "\n".join([f"# {x}\r" for x in bsd])),
        (3, "\n".join(["The title\n", *mit, ""])),
        (4, "\n".join([*code, *gpl, *code, *[f"// {x}" for x in mit], *gpl])),  # no blank line anywhere
    ]
    got = licenses.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    found = {(r.row.doc_id, r.paragraph): r.family for r in got if r.confirmed and r.similarity >= 0.95}
    assert found == {(1, 3): "gpl", (2, 0): "bsd", (3, 2): "mit", (4, 400): "gpl", (4, 804): "mit", (4, 807): "gpl"}
    assert {(r.row.doc_id, r.paragraph) for r in got} == set(found) and got[0].text.startswith(" ".join(gpl[:2]))
