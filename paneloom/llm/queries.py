"""The registered queries of the training-data operators, each with its SQL where SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm import html_text, importance, jaccard, langid, licenses, mixing, packing, prefix_trie, quality, sharding, superminhash, topk, warc

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit_languages(docs.where(langid.learnable()), order=F.col("doc_id"))
    return langid.predict_languages(docs, model).select(
        "row.doc_id", (~langid.learnable("row.doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


QUALITY_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), lines as (
  select doc_id, no, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as w
  from (select doc_id, generate_subscripts(string_split(t, chr(10)), 1) as no, unnest(string_split(t, chr(10))) as line from d)
), judged as (
  select doc_id, line, len(w) as words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as chars,
    length(line) - length(translate(line, '#*$%&|<>', '')) as symbols,
    len(regexp_extract_all(line, '%s')) as phrases, length(line) - length(replace(line, '|', '')) as bars, length(line) - length(replace(line, '!', '')) as bangs
  from lines
), lost as (
  select doc_id, sum(chars) filter (where words > 0 and (symbols >= 3 and symbols * 10 > chars
      or bangs >= 3 and bangs * 3 > words or bars >= 2 and bars * 3 >= words or phrases >= 1 and phrases * 20 >= words)) as lost,
    count(*) filter (where words > 0) - count(distinct line) filter (where words > 0) as dup
  from judged group by doc_id
), wins as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as win
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as n from wins) where n >= 2
), covered as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by doc_id
), m as (
  select d.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols, dup::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words, coalesce(lost, 0) as lost
  from d join lost using (doc_id) left join covered c using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * lost <= 30 * word_chars as kept
from m
""".replace("%s", quality.PHRASES).replace("translate(line, '#*$%&|<>', '')", "regexp_replace(line, '[#*$%&|<>]', '', 'g')").replace("translate(t, '#*$%&|<>', '')", "regexp_replace(t, '[#*$%&|<>]', '', 'g')")


@query("op5_line_quality", QUALITY_SQL)
def line_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.clean_lines(table(spark, folder, "documents"))
    return judged.select("row.doc_id", *quality.MEASURES[:5], "base_failed", "kept")


@query("op3_shards")
def shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shuffle_into_shards(table(spark, folder, "documents"), 8, seed=3)
    text = F.col("row.text").cast("binary")
    return placed.select(
        "row.doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b"").cast("binary"))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


WARC_SQL = """
with p as (
  select page_id, coalesce(html, '') as payload, encode(coalesce(html, '')) as bytes from pages
), s as (
  select page_id, payload, octet_length(bytes)::bigint as payload_bytes, sha1(bytes) as hex,
    max(page_id) over (partition by payload) as last from p
)
select page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::bigint >> (15 - 5 * (i % 4)))) & 31)::int + 1, 1)), 'string_agg', '') as payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type,
  case when page_id <> last then last end as refers_to
from s
"""


@query("op4_archive", WARC_SQL)
def archive(spark: SparkSession, folder: str) -> DataFrame:
    written = warc.write_archive(table(spark, folder, "pages"))
    return warc.read_archive(spark, written).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@query("op1_hilbert_packing")
def hilbert_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(packing.tokenize(table(spark, folder, "documents"), vocabulary()))
    return pieces.select(
        "row.doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


MIXING_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    greatest(0.05::double, coalesce(1 - 4.0::double * (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g'))) / nullif(length(text), 0), 0)) as quality,
    md5(coalesce(text, '')) as content,
    ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::bigint as bits
  from documents
), keyed as (
  select *, -ln((bits::double + 0.5) / 4503599627370496.0::double) / quality as key from d
), sizes as (
  select source, sum(size)::bigint as source_size from d group by source
), weighed as (
  select *, [5, 2, 1][(no % 3 + 1)::int]::double as weight, 2.0::double * source_size as cap
  from (select *, row_number() over (order by source nulls last) - 1 as no from sizes)
), levels as (
  select *, cap / weight as ratio, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over lower, 0)) / sum(weight) over upper as level
  from weighed window lower as (order by cap / weight, no rows between unbounded preceding and 1 preceding),
    upper as (order by cap / weight, no rows between current row and unbounded following)
), targets as (
  select source, source_size, coalesce(least(cap, weight * max(level) over ()), cap) as target from levels
), ordered as (
  select k.doc_id, k.size, t.source_size, t.target, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as epochs,
    coalesce(sum(size) over (partition by k.source order by key, size, content rows between unbounded preceding and 1 preceding), 0) as before
  from keyed k join targets t on k.source is not distinct from t.source
)
select doc_id, size, source_size, round(target, 6) as target,
  ((epochs + case when size > 0 and before + size / 2.0 <= target - epochs * source_size then 1 else 0 end) * size)::bigint as taken
from ordered
"""


@query("op9_source_mix", MIXING_SQL)
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as code from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), s as (
  select q.vec_id as query_id, v.vec_id, list_inner_product(q.code, v.code)::bigint as score
  from v q join v on q.vec_id % 50 = 0 and q.vec_id <> v.vec_id and len(q.code) = len(v.code)
), r as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s
)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""


@query("op6_block_topk", TOP_K_SQL)
def block_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op10_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages")).select(
        "row.page_id", "row.url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )


@query("op8_licenses")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = licenses.scan_licences(docs, licenses.fit_licences(docs))
    return found.select("row.doc_id", "paragraph", "family", F.round("probability", 6).alias("probability"), "similarity", "confirmed", "text")


@query("op7_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, folder, "documents"), width=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


#: An unsigned CRC-32 of a text's UTF-8 bytes, by its table of 256 numbers.
CRC_TABLE = """crc_table as materialized (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as tab
  from range(256) r(i))"""


def crc_sql(text: str) -> str:
    octets = f"list_transform(range(0, length(hex({text})), 2), lambda i: ('0x' || substr(hex({text}), (i + 1)::int, 2))::bigint)"
    turned = f"list_reduce(list_concat([4294967295::bigint], {octets}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))"
    return f"xor({turned}, 4294967295::bigint)"


IMPORTANCE_SQL = rf"""
with {CRC_TABLE}, texts as (
  select doc_id, coalesce(text, '') as t, true as mine from documents union all select null, coalesce(text, ''), false from benchmark
), split as (
  select doc_id, mine, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from texts
), counted as (
  select mine, w, count(*) as n from (select mine, unnest(words) as w from split) group by mine, w
), hashed as (
  select w, {crc_sql('w')} % 10000 as bucket from (select distinct w from counted), crc_table
), buckets as (
  select bucket, coalesce(sum(n) filter (where mine), 0)::double as s, coalesce(sum(n) filter (where not mine), 0)::double as t from counted join hashed using (w) group by bucket
), gains as (
  select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from buckets) + 10000) / ((s + 1) * ((select sum(t) from buckets) + 10000))))::bigint as gain from buckets
), by_word as (
  select w, gain from hashed join gains using (bucket)
), numbered as (
  select row_number() over () as no, doc_id, words from split where mine
), weights as (
  select no, sum(gain)::bigint as weight from (select no, unnest(words) as w from numbered) join by_word using (w) group by no
), scored as (
  select no, doc_id, len(words)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint::double + 0.5) / 4294967296.0::double)))::bigint as score
  from numbered left join weights using (no)
), ranked as (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last) as place, count(*) over (partition by n_features >= 20) as able from scored
)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= able * 10 // 100 then place end as rank from ranked
"""


@query("op12_importance", IMPORTANCE_SQL)
def importance_draw(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.importance_sample(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), features=importance.Features(width=1, buckets=10_000)
    )
    return found.select("row.doc_id", "n_features", "weight", "score", "rank")


@query("op13_superminhash")
def superminhash_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = superminhash.near_duplicates(table(spark, folder, "documents"), superminhash.Near(width=5, percent=85))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


TRIE_SQL = f"""
with {CRC_TABLE}, coded as (
  select conv_id, turn, length(coalesce(text, ''))::bigint as len,
    substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) as code
  from conversations where conv_id is not null
), t as (
  select conv_id, len, code, row_number() over (partition by conv_id order by turn nulls first, code, len) as pos from coded
), convs as (
  select conv_id, conv_id - conv_id % 100 as base, {crc_sql('conv_id::varchar')} % 6 as h from (select distinct conv_id from t), crc_table
), rebuilt as (
  select c.conv_id, pos, code, len from convs c join t on t.conv_id = c.base and pos <= h
  union all
  select c.conv_id, pos, code, len from convs c join t on t.conv_id = c.conv_id and pos > h
), walked as (
  select conv_id, row_number() over w as depth, len, string_agg(code || lpad(to_hex(len), 8, '0'), '') over w as path
  from rebuilt window w as (partition by conv_id order by pos)
  union all
  select conv_id, 0, 0, '' from convs
), nodes as (
  select depth, path, any_value(len) as len, min(conv_id) as conv_id, count(*) as n_convs from walked group by depth, path
), children as (
  select substr(path, 1, (40 * (depth - 1))::int) as path, count(*) as n_children from nodes where depth > 0 group by 1
), subtree as (
  select substr(n.path, 1, (40 * d)::int) as path, sum((n_convs - 1) * len)::bigint as saved_tokens, count(*) filter (where n_children is null) as n_leaves
  from (select *, unnest(range(0, depth + 1)) as d from nodes) n left join children c on c.path = n.path group by 1
), ends as (
  select path, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
  from (select conv_id, arg_max(path, depth) as path from walked group by conv_id) group by path
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens,
  coalesce(ends_sha256, sha256('')) as ends_sha256
from nodes n join subtree s using (path) left join children c using (path) left join ends e using (path)
  left join nodes p on n.depth > 0 and p.path = substr(n.path, 1, (40 * (n.depth - 1))::int)
"""


@query("op11_prefix_trie", TRIE_SQL)
def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(*prefix_trie.shared_openings(prefix_trie.turns(table(spark, folder, "conversations"))))
