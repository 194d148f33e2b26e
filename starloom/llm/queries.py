"""The queries of this package: each operator over its whole table."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    decontaminate,
    divergence,
    language,
    minhash,
    mixing,
    packing,
    sharding,
    sketch,
    spelling,
    token_counts,
    toxicity,
    url_filter,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_records(docs).select(
        "doc_id",
        sharding.record_bytes(F.col("text")).alias("size"),
        sharding.crc32_of(F.col("text")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, index = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(path, index)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op6_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.held_out(F.col("doc_id"))
    found = language.identify(docs, language.learn(docs.where(~out)))
    return found.withColumn("held_out", F.coalesce(out, F.lit(False)))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weigh_documents(_table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_sharding": op2_sharding,
    "op3_minhash": op3_minhash,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_sketch": op6_sketch,
    "op7_language": op7_language,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_mixing": op10_mixing,
    "op11_packing": op11_packing,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling_variants": op13_spelling_variants,
}


def _quoted(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("'", "''") + "'"


def _regex(glob: str) -> str:
    """A glob as a regular expression for the whole canonical URL."""
    parts = re.split(r"(\*\*|\*)", glob)
    kinds = {"**": "(?s:.*)", "*": "[^/]*"}
    return "".join(kinds.get(part, re.escape(part)) for part in parts)


def _url_filter_sql() -> str:
    rules = ", ".join(
        f"({i}, {_quoted(r.name)}, {_quoted(r.action)}, {_quoted(r.host)}, {_quoted(r.path)})"
        for i, r in enumerate(sorted(url_filter.HOST_RULES, key=lambda r: len(r.name)))
    )
    globs = ", ".join(f"({i}, {_quoted(g)}, {_quoted(_regex(g))})" for i, g in enumerate(url_filter.BLOCKED))
    return f"""
with rules(n, rule, action, rule_host, rule_path) as (values {rules}),
globs(n, pick, pattern) as (values {globs}),
cut as (
    select page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') as raw_host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
    from pages
),
parts as (
    select page_id, path, translate(raw_host, '{url_filter.UPPER}', '{url_filter.LOWER}') as host from cut
),
distinct_parts as (select distinct host, path from parts),
fitting as (
    select host, path, arg_max(rule, n) as rule, arg_max(action, n) as action
    from distinct_parts join rules
        on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by host, path
),
globbed as (
    select host, path, arg_min(pick, n) as pick
    from distinct_parts join globs on regexp_full_match(host || path, pattern)
    group by host, path
)
select page_id, p.host, p.path, f.rule,
    coalesce(f.action, case when g.pick is not null then 'block' else 'allow' end) as verdict,
    case when f.rule is null then g.pick end as "glob"
from parts p
left join fitting f on f.host = p.host and f.path = p.path
left join globbed g on g.host = p.host and g.path = p.path
"""


_WARC_SQL = """
with payloads as (select page_id, encode(coalesce(html, '')) as payload from pages),
hashed as (
    select page_id, octet_length(payload) as payload_bytes, sha1(payload) as hex,
        max(page_id) over (partition by payload) as last
    from payloads
)
select page_id, payload_bytes,
    array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::int >> (15 - 5 * (i % 4))) & 31), 1)
        for i in range(32)
    ], '') as payload_digest,
    case when page_id = last then 'response' else 'revisit' end as record_type,
    case when page_id <> last then last end as refers_to
from hashed
"""

# Every pair of documents that shares a shingle, and everything within reach.
_MINHASH_SQL = f"""
with recursive words as (
    select doc_id, [w for w in string_split_regex(
        translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'),
        '[\\x20\\x09-\\x0D]+') if w <> ''] as w
    from documents
),
cut as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end as s
    from words
),
shingles as (select distinct doc_id, unnest(s) as s from cut),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as x, b.doc_id as y, count(*) as c
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
    group by all
),
links as (
    select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
    where 100 * c >= 75 * (p.n + q.n - c)
),
either_way as (select x, y from links union all select y, x from links),
reach(doc_id, r) as (
    select doc_id, doc_id from documents
    union
    select reach.doc_id, y from reach join either_way on x = r
),
least_of as (select doc_id, min(r) as component_id from reach group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join least_of using (doc_id) left join sizes using (doc_id)
"""

ORACLE: dict[str, str] = {
    "op1_url_filter": _url_filter_sql(),
    "op3_minhash": _MINHASH_SQL,
    "op4_warc": _WARC_SQL,
}
