"""The queries ``opN_<name>`` over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import (
    bloom_lm, bpe_automaton, decontaminate, language_gru, merkle_manifest, quality_rules, repeats, secret_cnn,
    simhash, source_mix, toxic_crf, url_digest, whitening,
)
from kinfold.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
URL_RULES = (
    url_digest.Rule("com", "/", "allow"),
    url_digest.Rule("example.com", "/en/", "block"),
    url_digest.Rule("www.example.com", "/en/", "allow"),
    url_digest.Rule("net", "/es/", "block"),
    url_digest.Rule("net", "/fr/", "block"),
)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_OP1 = r"""
with rows_ as (
  select row_number() over () as rid, doc_id, source, coalesce(text, '') as text from documents),
parts as (
  select rid, doc_id, source, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from rows_),
places as (select rid, words, unnest(range(1, len(words) - 6)) as i from parts),
windows as (select rid, i, array_to_string(words[i:i + 7], ' ') as g from places),
repeated as (select rid, i from windows qualify count(*) over (partition by rid, g) > 1),
covered as (
  select rid, count(distinct j) as n
  from (select rid, unnest(range(i, i + 8)) as j from repeated) group by rid),
counts as (
  select doc_id, source as host, cast(len(words) as bigint) as n_words,
         cast(length(array_to_string(words, '')) as bigint) as word_chars,
         cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         coalesce(n, 0) as n_repeat_words
  from parts left join covered using (rid)),
judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counts),
hosts as (
  select host, count(*) as n_docs, count(*) filter (base_failed) as n_failed from judged group by host),
moments as (select avg(n_failed / n_docs) as m, var_pop(n_failed / n_docs) as v from hosts),
prior as (
  select m, case when v > 0 then greatest(2.0, m * (1 - m) / v - 1) else 2.0 end as weight from moments),
verdicts as (
  select host as host_, (n_failed + m * weight) / (n_docs + weight) > 0.5 as host_failed from hosts, prior)
select doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed,
       not base_failed and not host_failed as kept
from judged left join verdicts on host is not distinct from host_
"""


@query(_OP1)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and host verdicts of all documents."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query()
def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return bpe_automaton.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), "doc_id")


def _rule_values() -> str:
    return ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)


_OP9 = f"""
with rules(rule_host, rule_path, rule_verdict) as (values {_rule_values()}),
split as (
  select row_number() over () as rid, page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
fits as (
  select rid, rule_host || rule_path as rule, rule_verdict
  from split join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  qualify row_number() over (partition by rid order by length(rule_host || rule_path) desc) = 1)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from split left join fits using (rid)
"""


@query(_OP9)
def op9_url_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the URL of every page."""
    return url_digest.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query()
def op4_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact unigram score and the filter's score of every document."""
    return bloom_lm.score(table(spark, sf_dir, "documents"))


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and component of every document."""
    return simhash.components(table(spark, sf_dir, "documents"))


@query()
def op8_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language_gru.identify(table(spark, sf_dir, "documents"))


@query()
def op7_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    scored = toxic_crf.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query()
def op3_secret_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    return secret_cnn.scan(table(spark, sf_dir, "documents"))


_OP5 = r"""
with words_ as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
held as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from words_)),
item_words as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from benchmark),
wanted as (
  select distinct item_id, array_to_string(w[i:i + 4], ' ') as g
  from (select item_id, w, unnest(range(1, len(w) - 3)) as i from item_words)),
sizes as (select item_id, count(*) as n_item from wanted group by item_id),
shared as (select doc_id, item_id, count(*) as n_shared from held join wanted using (g) group by doc_id, item_id)
select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
from shared join sizes using (item_id) where n_shared >= ceil(0.8 * n_item)
"""


@query(_OP5)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of every document that repeat earlier ones."""
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("spans")


_OP11 = r"""
with recursive docs as (
  select *,
    -- CRC-32 of the id's digits, bit by bit
    xor(list_reduce(
      list_prepend(4294967295::bigint, flatten(list_transform(string_split(cast(doc_id as varchar), ''),
        lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
      lambda t, b: xor(xor(t, b) >> 1, 3988292384 * (xor(t, b) & 1))), 4294967295) as crc
  from documents),
parts as (
  select doc_id, lang, n_chars,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as head,
    coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') as middle,
    case when crc % 7 = 0 and n_chars is not null
      then strlen(cast(n_chars + 1 as varchar)) || ':' || cast(n_chars + 1 as varchar) end as other,
    coalesce(strlen(text) || ':' || text, '-') as tail
  from docs),
hashed as (
  select doc_id, lang, sha256(head || middle || tail) as leaf,
    case when other is not null then sha256(head || other || tail) end as tampered
  from parts),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i,
    count(*) over (partition by lang) as n from hashed),
langs as (select lang, n, dense_rank() over (order by lang nulls first) - 1 as t from (select distinct lang, n from leaves)),
trees(t, level, i, n, digest) as (
  select t, 0, i, leaves.n, leaf from leaves join langs on leaves.lang is not distinct from langs.lang
  union all
  select t, level + 1, i // 2, max((n + 1) // 2), sha256(string_agg(digest, '' order by i))
  from trees where n > 1 group by t, level, i // 2),
tops as (select t, digest as subroot, (select count(*) from langs) as m from trees where n = 1),
upper_(level, i, n, digest) as (
  select 0, t, m, subroot from tops
  union all
  select level + 1, i // 2, max((n + 1) // 2), sha256(string_agg(digest, '' order by i))
  from upper_ where n > 1 group by level, i // 2),
-- One climb for the true leaf and one for the changed one, with the siblings met so far.
climb(rid, doc_id, leaf, t, i, n, level, j, folded, met) as (
  select row_number() over (), doc_id, leaf, t, i, leaves.n, 0, i, coalesce(tampered, leaf), ''
  from leaves join langs on leaves.lang is not distinct from langs.lang
  union all
  select c.rid, c.doc_id, c.leaf, c.t, c.i, (c.n + 1) // 2, c.level + 1, c.j // 2,
    sha256(case when s.digest is null then c.folded when c.j % 2 = 1 then s.digest || c.folded else c.folded || s.digest end),
    c.met || coalesce(s.digest, '')
  from climb c left join trees s on s.t = c.t and s.level = c.level and s.i = xor(c.j, 1)
  where c.n > 1),
climb2(rid, doc_id, leaf, t, n, level, j, folded, met) as (
  select rid, doc_id, leaf, t, m, 0, t, folded, met from climb join tops using (t) where n = 1
  union all
  select c.rid, c.doc_id, c.leaf, c.t, (c.n + 1) // 2, c.level + 1, c.j // 2,
    sha256(case when s.digest is null then c.folded when c.j % 2 = 1 then s.digest || c.folded else c.folded || s.digest end),
    c.met || coalesce(s.digest, '')
  from climb2 c left join upper_ s on s.level = c.level and s.i = xor(c.j, 1)
  where c.n > 1)
select doc_id, leaf, subroot, root, sha256(met) as proof_sha256, folded as folded_root, folded = root as verified
from climb2 join tops using (t), (select digest as root from upper_ where n = 1) where climb2.n = 1
"""


@query(_OP11)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaf, proof and root of every document, and whether a changed one is found out."""
    return merkle_manifest.verified(table(spark, sf_dir, "documents"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_OP13 = r"""
with sized as (
  select doc_id, source, cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as bigint) as size,
    md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from sized group by source),
-- Sources in the order in which they would reach their limit: words and weight that are left before each.
filled as (
  select *, cast(sum(source_size) over () - 3 * coalesce(sum(source_size) over before_, 0) as bigint) as left_,
    cast(sum(weight) over () - coalesce(sum(weight) over before_, 0) as bigint) as weight_left
  from sources
  window before_ as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
level_ as (
  select left_ as r, weight_left as w from filled
  where 3 * source_size * weight_left >= left_ * weight order by weight_left desc limit 1),
goals as (
  select source, source_size,
    case when 3 * source_size * w < r * weight then cast(3 * source_size as double)
      else cast(r * weight as double) / cast(w as double) end as target,
    case when 3 * source_size * w < r * weight then 3 * source_size else r * weight // w end as budget
  from sources, level_),
placed as (
  select doc_id, size, source_size, target, budget,
    coalesce(sum(size) over (partition by sized.source order by key, size rows between unbounded preceding and 1 preceding), 0) as before_
  from sized join goals on sized.source is not distinct from goals.source)
select doc_id, size, source_size, target,
  cast(case when source_size = 0 then 0 else budget // source_size * size
    + greatest(0, least(size, budget % source_size - before_)) end as bigint) as taken
from placed
"""


@query(_OP13)
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix by source weights takes."""
    return source_mix.taken_words(table(spark, sf_dir, "documents"))
