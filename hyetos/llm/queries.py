"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hyetos.llm import (
    alignment,
    decontamination,
    fingerprints,
    huffman,
    language,
    line_dedup,
    merkle,
    packing,
    quality,
    similarity_join,
    tokens,
    toxicity,
    url_filter,
    warc,
)
from hyetos.llm.common import stored, table
from hyetos.session import work_dir

#: The rules of the URL query (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=20
    )


CONTAMINATION_SQL = r"""
with texts as (
    select 'd' kind, doc_id id, text from documents
    union all select 'i', item_id, text from benchmark),
cut as (
    select kind, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
    from texts),
windows as (
    select distinct id item_id, array_to_string(w[s:s + 9], ' ') phrase, least(len(w), 10) n
    from (select id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) s
          from cut where kind = 'i' and len(w) > 0)),
grams as (
    select id doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') phrase
    from (select id, w, n, unnest(generate_series(1, len(w) - n + 1)) s
          from cut, (select distinct n from windows) where kind = 'd')),
hits as (select doc_id, s, n, item_id from grams join windows using (n, phrase)),
words as (
    select doc_id, count(distinct p) n_hit
    from (select doc_id, unnest(generate_series(s, s + n - 1)) p from (select distinct doc_id, s, n from hits))
    group by 1),
items as (
    select doc_id, count(*) n_items, string_agg(i, ',' order by i) ids
    from (select distinct doc_id, item_id::varchar i from hits) group by 1),
places as (select id doc_id, unnest(w) word, generate_subscripts(w, 1) p from cut where kind = 'd'),
terms as (select distinct phrase, unnest(string_split(phrase, ' ')) word from windows),
ranked as (
    select phrase, word, count(*) over (partition by phrase) k,
           row_number() over (partition by phrase order by coalesce(c, 0), word) r
    from terms left join (select word, count(*) c from places group by 1) using (word)),
anchors as (select phrase, k, doc_id, p from ranked join places using (word) where r = 1),
close as (
    select distinct phrase, doc_id from (
        select a.phrase, a.doc_id, a.p
        from anchors a join terms t on a.phrase = t.phrase
        join places o on o.doc_id = a.doc_id and o.word = t.word and abs(o.p - a.p) <= 20
        group by a.phrase, a.doc_id, a.p, a.k having count(distinct t.word) = a.k)),
near as (
    select doc_id, count(distinct item_id) n_near from close join windows using (phrase) group by 1)
select id doc_id, len(w)::bigint n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(ids, '')) items_sha256, n_hit is not null contaminated,
       coalesce(n_near, 0) n_near
from cut left join words on id = words.doc_id left join items on id = items.doc_id
left join near on id = near.doc_id
where kind = 'd'
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.fold("doc_id", 4) == 2
    model = language.train(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write(warc.resolve(table(spark, sf_dir, "pages")), path)
    headers = warc.read(spark, path).drop("payload")
    return warc.with_originals(headers).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


WARC_SQL = """
select page_id, payload_bytes, payload_digest,
       case when revisits then 'revisit' else 'response' end record_type,
       case when revisits then keeper end refers_to
from (select *, payload_bytes >= 1000 and keeper is not null
             and page_id is distinct from keeper revisits
      from (select page_id, strlen(coalesce(html, ''))::bigint payload_bytes,
                   sha1(coalesce(html, '')) payload_digest,
                   max(page_id) over (partition by coalesce(html, '')) keeper
            from pages))
"""


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = stored(packing.token_pieces(docs, tokens.default_path()), "pieces")
    return packing.pack(pieces)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(toxicity.fold("doc_id", 5) != 0)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    held_out = (toxicity.fold("doc_id", 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op8_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.join(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return huffman.round_trip(docs, tokens.default_path(), work_dir(spark, "token-files"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, url_filter.rules_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


URL_SQL = r"""
with parts as (
    select page_id,
           coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') path
    from pages),
rules(rule_host, rule_path, rule_verdict) as (values
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fitting as (
    select host, path, rule_host || rule_path rule, rule_verdict,
           row_number() over (partition by host, path
               order by length(rule_host || rule_path) desc, length(rule_host) desc) place
    from (select distinct host, path from parts), rules
    where (host = rule_host or ends_with(host, '.' || rule_host))
      and starts_with(path, rule_path))
select page_id, p.host, p.path, rule, coalesce(rule_verdict, 'allow') verdict
from parts p left join fitting f on p.host = f.host and p.path = f.path and f.place = 1
"""


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(toxicity.fold("doc_id", 5) != 0)
    found = quality.classify(table(spark, sf_dir, "documents"), labels)
    held_out = (toxicity.fold("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "score", "predicted")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align_documents(table(spark, sf_dir, "documents"), *paths)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


MERKLE_SQL = """
with recursive fields as (
    select row_number() over () row, doc_id, lang, n_chars,
           coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') a,
           coalesce(strlen(text) || ':' || text, '-') b
    from documents),
leaves as materialized (
    select row, doc_id, lang,
           sha256(a || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || b) leaf,
           sha256(a || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || b) changed
    from fields),
bytes as (
    select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
        case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by i) crc_table
    from range(256) r(i)),
crcs as (
    select row, xor(4294967295, list_reduce(
        list_prepend(4294967295, [ascii(c)::bigint for c in string_split(doc_id::varchar, '')]),
        lambda c, x: xor(crc_table[(xor(c, x) & 255) + 1], c >> 8))) crc
    from leaves, bytes),
placed as materialized (
    select *, dense_rank() over (order by lang nulls first) tree,
           row_number() over (partition by lang order by doc_id nulls first, leaf, row) - 1 place
    from leaves),
nodes as (
    select tree, 0 level, place, leaf hash, count(*) over (partition by tree) width from placed
    union all
    select tree, level + 1, place // 2, sha256(string_agg(hash, '' order by place)),
           (any_value(width) + 1) // 2
    from nodes where width > 1 group by tree, level, place // 2),
subroots as materialized (
    select tree, level height, hash, row_number() over (order by tree) - 1 place from nodes where width = 1),
tops as (
    select 0 level, place, hash, count(*) over () width from subroots
    union all
    select level + 1, place // 2, sha256(string_agg(hash, '' order by place)), (any_value(width) + 1) // 2
    from tops where width > 1 group by level, place // 2),
steps as materialized (
    select row, n.level, p.place >> n.level spot, s.hash
    from placed p join nodes n on n.tree = p.tree and n.place = p.place >> n.level and n.width > 1
    left join nodes s on s.tree = n.tree and s.level = n.level and s.place = xor(n.place, 1)
    union all
    select row, r.height + n.level, r.place >> n.level, s.hash
    from placed p join subroots r using (tree)
    join tops n on n.place = r.place >> n.level and n.width > 1
    left join tops s on s.level = n.level and s.place = xor(n.place, 1)),
proofs as (select row, sha256(string_agg(coalesce(hash, ''), '' order by level)) proof from steps group by row),
folds as (
    select row, 0 level, case when doc_id is not null and crc % 7 = 0 then changed else leaf end hash
    from placed join crcs using (row)
    union all
    select f.row, f.level + 1,
           sha256(case when s.spot % 2 = 1 then coalesce(s.hash, '') || f.hash else f.hash || coalesce(s.hash, '') end)
    from folds f join steps s on s.row = f.row and s.level = f.level),
ends as (select row, arg_max(hash, level) folded_root from folds group by row)
select doc_id, leaf, r.hash subroot, t.hash root, coalesce(proof, sha256('')) proof_sha256,
       folded_root, folded_root = t.hash verified
from placed p join subroots r using (tree) join ends using (row)
left join proofs using (row) cross join (select hash from tops where width = 1) t
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_fingerprints": op3_fingerprints,
    "op4_language": op4_language,
    "op5_warc": op5_warc,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_similarity_join": op8_similarity_join,
    "op9_token_files": op9_token_files,
    "op10_url_filter": op10_url_filter,
    "op11_quality": op11_quality,
    "op12_alignment": op12_alignment,
    "op13_merkle": op13_merkle,
}
ORACLES: dict[str, str] = {
    "op2_decontamination": CONTAMINATION_SQL,
    "op5_warc": WARC_SQL,
    "op10_url_filter": URL_SQL,
    "op13_merkle": MERKLE_SQL,
}
