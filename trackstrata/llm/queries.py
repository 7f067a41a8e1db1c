"""The corpus operators over the test tables, one query each, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, conversations, decontaminate, html_text, language_id, licenses, near_dup, packing, pii, quality_rules, ranked_search, url_filter, warc
from .common import crc_fold
from .licenses_sql import licenses_twin
from .quality_sql import QUALITY
from .repair_sql import REPAIR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


URL_RULES = [
    *url_filter.domain_rules("net", "/", "block"),
    *url_filter.domain_rules("example.net", "/en/", "allow"),
    *url_filter.domain_rules("example.com", "/de/", "block"),
    *url_filter.domain_rules("org", "/fr/", "allow"),
]
#: the method's own rules: they decide where no base rule fits
URL_GLOBS = [
    url_filter.Rule(".spam*", "block", ".spam*", 0),
    url_filter.Rule(".spam*/**", "block", ".spam*/**", 0),
    url_filter.Rule("*casino*", "block", "*casino*", 0),
    url_filter.Rule("*casino*/**", "block", "*casino*/**", 0),
    url_filter.Rule("**/wp-admin/**", "block", "**/wp-admin/**", 0),
    url_filter.Rule("**.exe", "block", "**.exe", 0),
]


@query
def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    distances = [(F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c) for c in ("char_distance", "word_distance")]
    return quality_rules.divergence(docs).select(*columns, *distances)


@query
def op2_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, [*URL_RULES, *URL_GLOBS])
    base = F.when(F.col("rule").isin(sorted({r.name for r in URL_RULES})), F.col("rule"))
    return judged.select("page_id", "host", "path", base.alias("rule"), "verdict")


@query
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = crc_fold("doc_id", 3) == 1
    model = language_id.train_languages(docs, usable=~held_out)
    return language_id.predict_languages(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op4_pii(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("all_spans")


@query
def op5_decontaminate(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return decontaminate.decontaminate(docs, items, keep=["doc_id"]).select(*columns)


@query
def op6_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    records = warc.archived(pages.select("page_id", "url", "html"))
    number = pages.schema["page_id"].dataType
    return records.select(
        F.col("id").cast(number).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to").cast(number).alias("refers_to")
    )


@query
def op7_licenses(spark, sf_dir):
    """Documents as files of the directory source/lang; a text that is for the most part a licence notice is a licence file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    notice = F.length(licenses.notice_of("source", "text"))
    name = F.when(2 * notice > F.length("text"), F.concat(F.lit("LICENSE."), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
    files = docs.withColumn("path", F.concat_ws("/", "source", "lang", name))
    return licenses.scan_licenses(files, keep=["doc_id", "path"])


@query
def op8_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_fold("doc_id", 5) == 0
    model = classifier.train_quality(docs, labels, usable=~held_out)
    return classifier.score_quality(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op9_near_duplicates(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])


@query
def op10_packing(spark, sf_dir):
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(pieces)


@query
def op11_ranked_search(spark, sf_dir):
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_conversation_repair(spark, sf_dir):
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")), times="times")


@query
def op13_main_text(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


ORACLE: dict[str, str] = {
    "op2_url_filter": r"""
with parts as (
  select page_id,
         case when instr(coalesce(url, ''), '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), split as (
  select page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
), judged as (
  select page_id, host, path,
         case when ends_with('.' || host, '.example.net') and starts_with(path, '/en/') then 'example.net/en/'
              when ends_with('.' || host, '.example.com') and starts_with(path, '/de/') then 'example.com/de/'
              when ends_with('.' || host, '.org') and starts_with(path, '/fr/') then 'org/fr/'
              when ends_with('.' || host, '.net') and starts_with(path, '/') then 'net/' end as rule
  from split
)
select page_id, host, path, rule,
       case when rule in ('example.net/en/', 'org/fr/') then 'allow'
            when rule is not null then 'block'
            when starts_with(host, 'spam') or contains(host, 'casino') or contains(path, '/wp-admin/') or ends_with(host || path, '.exe') then 'block'
            else 'allow' end as verdict
from judged
""",
    "op5_decontaminate": r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), item_windows as (
  select distinct item_id, least(10, len(w)) as n, w[i : i + least(10, len(w)) - 1] as g
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from item_words where len(w) > 0)
), sizes as (select distinct n from item_windows),
doc_windows as (
  select doc_id, n, i, w[i : i + n - 1] as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, sizes where len(w) >= n)
), found as (
  select doc_id, i, d.n, item_id from doc_windows d join item_windows using (g)
), hits as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as s
  from (select distinct doc_id, cast(item_id as varchar) as s from found) group by doc_id
)
select words.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (doc_id) left join items using (doc_id)
""",
    "op6_warc": r"""
with digested as (
  select page_id, octet_length(encode(coalesce(html, ''))) as size, sha256(coalesce(html, '')) as digest from pages
), firsts as (select digest, min(page_id) as page_first from digested group by digest)
select page_id, cast(size as bigint) as payload_bytes, digest as payload_digest,
       case when size >= 100 and page_id <> page_first then 'revisit' else 'response' end as record_type,
       case when size >= 100 and page_id <> page_first then page_first end as refers_to
from digested join firsts using (digest)
""",
    "op11_ranked_search": r"""
with words as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), corpus as (select count(*) filter (len(w) > 0) as n, cast(sum(len(w)) as bigint) as l from words),
item_terms as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), counted as (
  select r, doc_id, size, term, count(*) as tf from (select r, doc_id, len(w) as size, unnest(w) as term from words)
  where term in (select term from item_terms) group by r, doc_id, size, term
), weights as (
  select term, cast(floor(1000 * ln((2 * n + 2)::double / (2 * count(*) + 1))) as bigint) as weight from counted, corpus group by term, n
), worth as (
  select r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * size * n) // l)))) as worth
  from counted join weights using (term), corpus
), scored as (
  select item_id, r, doc_id, cast(sum(worth) as bigint) as score from item_terms join worth using (term) group by item_id, r, doc_id
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 50
""",
    "op12_conversation_repair": REPAIR,
    "op1_quality_rules": QUALITY,
    "op7_licenses": licenses_twin(),
}
