"""The registered queries against their SQL, and the pipeline stage by stage, on the smallest tables."""

from __future__ import annotations

import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from paneloom.llm import langid, quality, queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: "NULL" if v is None or isinstance(v, float) and math.isnan(v) else repr(v)
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    got = queries.QUERIES[name](spark, FOLDER)
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        db.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    result = db.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count() > 0


def test_language_rejects_what_was_not_learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.fit_languages(docs.where(langid.learnable()), order=F.col("doc_id"))
    held = langid.predict_languages(docs.where(~langid.learnable()), model, ("doc_id", "lang")).collect()
    assert sum(r.rejected for r in held) <= 0.03 * len(held)
    assert sum(r.lang_pred == r.row.lang for r in held) >= 0.97 * len(held)
    rng = random.Random(2)
    letters = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))
    strange = [
        "Suomi on pohjoismainen valtio jonka pääkaupunki on Helsinki ja siellä asuu paljon ihmisiä jotka puhuvat suomea kotona sekä työssä.",
        "Türkiye Cumhuriyeti güzel bir ülkedir ve başkenti Ankara şehridir. İnsanlar burada yüzyıllardır yaşamaktadır.",
        "def main(argv):\n    for i in range(len(argv)):\n        print(argv[i], sep=',')\n    return sum(x for x in argv if x is not None)\n",
        letters(20), letters(80), letters(1000),
    ]
    got = langid.predict_languages(spark.createDataFrame(list(enumerate(strange)), "doc_id long, text string"), model).collect()
    assert [r.row.doc_id for r in got if not r.rejected] == []


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_line_fails(line):
    words = WORD.findall(line)
    symbols, bangs, bars = sum(c in "#*$%&|<>" for c in line), line.count("!"), line.count("|")
    phrases = len(re.findall(quality.PHRASES, line))
    return bool(words) and (
        symbols >= 3 and symbols * 10 > sum(map(len, words))
        or bangs >= 3 and bangs * 3 > len(words)
        or bars >= 2 and bars * 3 >= len(words)
        or phrases >= 1 and phrases * 20 >= len(words)
    )


def plain_quality(text):
    """The cleaned text, or None for a document that goes."""
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
        return None
    lines = text.split("\n")
    lost = sum(len(w) for line in lines if plain_line_fails(line) for w in WORD.findall(line))
    return None if 100 * lost > 30 * sum(map(len, words)) else "\n".join(line for line in lines if not plain_line_fails(line))


def plain_firsts(docs):
    """The smallest ids of the components of five-word shingles at 0.8."""
    sets = {}
    for d in docs:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in d.text))
        sets[d.doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and (both := len(sets[a] & sets[b])) and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {root(i) for i in sets}


def test_pipeline(spark, tmp_path):
    """Every stage's exact rows against a plain version, each on its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    every = lambda df: Counter(tuple(r) for r in df.collect())

    before = docs.collect()
    cleaned = stages["quality rules"](spark, docs, FOLDER).cache()
    expected = Counter()
    for d in before:
        if (text := plain_quality(d.text)) is not None:
            expected[(d.doc_id, text, d.lang, d.source, len(text))] += 1
    assert cleaned.columns == docs.columns and every(cleaned) == expected and len(expected) > 0.4 * len(before)

    known = stages["language"](spark, cleaned, FOLDER).cache()
    model = langid.fit_languages(cleaned.where(langid.learnable()), order=F.col("doc_id"))
    judged = {r.row.doc_id: r for r in langid.predict_languages(cleaned, model).collect()}
    expected = Counter((d.doc_id, d.text, judged[d.doc_id].lang_pred, d.source, d.n_chars) for d in cleaned.collect() if not judged[d.doc_id].rejected)
    assert every(known) == expected and sum(expected.values()) >= 0.97 * cleaned.count()
    labels = {d.doc_id: d.lang for d in before}
    assert sum(r.lang == labels[r.doc_id] for r in known.collect()) >= 0.97 * known.count()

    distinct = stages["near duplicates"](spark, known, FOLDER).cache()
    rows_known = known.collect()
    firsts = plain_firsts(rows_known)
    assert every(distinct) == Counter(tuple(d) for d in rows_known if d.doc_id in firsts) and len(firsts) < len(rows_known)

    mixed = stages["source mix"](spark, distinct, FOLDER).cache()
    path = str(tmp_path / "documents.parquet")
    distinct.toPandas().to_parquet(path)
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{path}'")
    taken = {doc_id: (size, words) for doc_id, size, words in db.execute(f"select doc_id, size, taken from ({queries.MIXING_SQL})").fetchall()}
    expected = Counter({tuple(d): taken[d.doc_id][1] // taken[d.doc_id][0] for d in distinct.collect()})
    assert every(mixed) == +expected and max(expected.values()) == 2

    packed = stages["packing"](spark, mixed, FOLDER).collect()
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    copies = Counter(r.doc_id for r in mixed.collect())
    pieces = {}
    for r in packed:
        assert len(r.ids) == 4 * r.length
        pieces.setdefault(r.doc_id, Counter())[(r.start, bytes(r.ids))] += 1
    assert set(pieces) == set(copies)
    for d in distinct.collect():
        if d.doc_id in copies:
            ids = np.array([*tokenizer.encode(d.text, add_special_tokens=False).ids, 0], "<u4").tobytes()
            assert all(ids[4 * start : 4 * start + len(piece)] == piece for start, piece in pieces[d.doc_id])
            assert sum(len(piece) * n for (_, piece), n in pieces[d.doc_id].items()) == copies[d.doc_id] * len(ids)
    places = Counter((r.sequence_id, p) for r in packed for p in range(r.offset, r.offset + r.length))
    assert max(places.values()) == 1 and all(p < 1024 for _, p in places)


def test_pipeline_of_odd_tables(spark):
    """Null ids, repeated rows and an empty table through every stage but the fits."""
    text = " ".join(f"w{i}x{i * i % 97}" for i in range(80))
    rows = [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (None, text + " end", "en", None, 9), (None, None, None, None, None), (2, "", "en", "b", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    for docs in (table, table.where("false")):
        for name in ("quality rules", "near duplicates", "source mix", "packing"):
            docs = stages[name](spark, docs, FOLDER).cache()
            found = docs.collect()
            if name == "near duplicates":
                assert [r.doc_id for r in found] in ([1], [])
