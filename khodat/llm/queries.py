"""The operators over their whole tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khodat.llm.alignment import alignment_digest
from khodat.llm.bpe import encode_digest
from khodat.llm.common import table
from khodat.llm.exact import duplicate_plan
from khodat.llm.extraction import extract_text
from khodat.llm.minhash import near_digest
from khodat.llm.mixing import mix_digest
from khodat.llm.pitman_yor import score_documents
from khodat.llm.quality import quality_digest
from khodat.llm.sharding import shard_documents
from khodat.llm.spelling import spelling_variants
from khodat.llm.url_rules import judge_urls
from khodat.llm.vectors import near_vectors
from khodat.llm.wavelet import token_digest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SITE_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_url_rules")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """Labels speak of pages by the same number: of low quality or toxic is blocked, else allowed."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    verdict = F.when(F.coalesce(bad, F.lit(False)), "block").when(F.coalesce("quality", "toxic").isNotNull(), "allow")
    pages = table(spark, sf, "pages").select("page_id", "url")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), verdict.alias("verdict"))
    return judge_urls(pages, pages.join(labels, "page_id").select("url", "verdict"), SITE_RULES)


@query("op2_shards")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return shard_documents(table(spark, sf, "documents"), shards=8)


@query("op3_vector_dedup", """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98
),
reach as (select vec_id as a, vec_id as b from v union select reach.a, links.b from reach join links on reach.b = links.a),
groups as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, coalesce(component_id, vec_id) as component_id,
  vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join groups on groups.a = vec_id left join counts on counts.a = vec_id
""")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings")).drop("row")


@query("op4_pitman_yor")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(table(spark, sf, "documents"))


@query("op5_minhash_dedup")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return near_digest(table(spark, sf, "documents"))


TOKENIZER = "word_bpe_49k.json"


@query("op6_bpe")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return encode_digest(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


@query("op7_mix")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return mix_digest(table(spark, sf, "documents"))


BARE = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


@query("op8_exact_dedup", f"""
with bare as (select doc_id, length(coalesce(text, '')) as points, {BARE} as bare from documents),
numbered as (
  select doc_id, bare, count(*) over (partition by bare) as group_size,
    first_value(doc_id) over (partition by bare order by points desc, doc_id) as keep_id,
    row_number() over (partition by bare order by points desc, doc_id) = 1 as kept
  from bare
)
select doc_id, keep_id, cast(group_size as bigint) as group_size, kept, sha256(bare) as text_sha256 from numbered
""")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_plan(table(spark, sf, "documents")).drop("row")


@query("op9_quality")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return quality_digest(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op10_extract")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(table(spark, sf, "pages"))


@query("op11_wavelet_ids")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return token_digest(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), end=2)


#: CRC-32 by half bytes, the lower first: the sums of 0 to 15 (fixed values).
CRC_STEPS = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
    "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)
LETTERS = r"[A-Za-z\x{00C0}-\x{00FF}]+"


@query("op12_spelling_variants", f"""
with recursive runs as (
  select doc_id, run, count(*) as times from (
    select doc_id, translate(unnest(regexp_extract_all(text, '{LETTERS}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents
  ) group by all
),
digits as (
  select *, hex(encode(cast(doc_id as varchar) || ':' || run)) as h from runs
),
summed as (
  select run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, length(h)), lambda i: strpos('123456789ABCDEF', substr(h, xor(i, 1) + 1, 1)))),
    lambda c, d: xor({CRC_STEPS}[(xor(c, d) & 15) + 1], c >> 4)
  )) as s from digits
),
words as (
  select word, cast(sum(times) as bigint) as n from (
    select times, case when s % 97 = 0 then substr(run, 1, s % length(run)) || substr(run, s % length(run) + 2) else run end as word from summed
  ) where length(word) >= 5 group by word having sum(times) >= 3
),
shorter as (
  select word, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, unnest(range(0, length(word))) as i from words)
),
near as (
  select a.word, b.word as other from shorter a join shorter b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select shorter.word, words.word from shorter join words on words.word = rest
  union select words.word, shorter.word from shorter join words on words.word = rest
),
best as (
  select near.word, count(*) as n_near, first(struct_pack(form := o.word, form_n := o.n) order by o.n desc, o.word) as top
  from near join words o on o.word = other group by near.word
),
formed as (
  select words.word, n, coalesce(n_near, 0) as n_near, case when top.form_n >= 2 * n then top.form end as form,
    case when top.form_n >= 2 * n then top.form_n end as form_n
  from words left join best on best.word = words.word
),
walk as (
  select word, word as at from formed
  union all select walk.word, form from walk join formed on formed.word = walk.at where form is not null
)
select formed.word, formed.form, walk.at as root, formed.n, formed.n_near, formed.form_n
from formed join walk on walk.word = formed.word join formed ends on ends.word = walk.at and ends.form is null
""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(table(spark, sf, "documents"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return alignment_digest(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
