"""The corpus operators as queries over the given tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import (
    alignment, bpe, chat, licenses, mixing, ngram_join, periodic, pieces, quality, secret_scan, topk, toxicity, url_filter,
)
from tillwatch.llm.common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(table(spark, sf_dir, "pages"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classified(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose two turns say what the template itself is made of."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat.report(turns.union(probe))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, a tenth of them with a tail that repeats itself as their id says; none where it is null."""
    seed = F.crc32(F.col("doc_id").cast("string"))
    tail = F.when(seed % 10 == 0, F.floor(seed / 10))
    return periodic.report(table(spark, sf_dir, "documents"), tail)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_ngram_join": op2_ngram_join,
        "op3_chat_format": op3_chat_format,
        "op4_bpe": op4_bpe,
        "op5_quality_rules": op5_quality_rules,
        "op6_topk_search": op6_topk_search,
        "op7_license_scan": op7_license_scan,
        "op8_mixing": op8_mixing,
        "op9_secret_scan": op9_secret_scan,
        "op10_toxicity": op10_toxicity,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_periodic": op12_periodic,
        "op13_alignment": op13_alignment,
    }


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP2 = rf"""
with recursive split as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), shingles as (
    select distinct doc_id, array_to_string(w[i : i + 4], ' ') as gram
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from split where len(w) > 0)
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.gram = b.gram and a.doc_id < b.doc_id
    join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
    group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))
), edges as (
    select a, b from links union all select b, a from links
), reached(id, other) as (
    select doc_id, doc_id from documents union select id, b from reached join edges on other = a
)
select documents.doc_id, coalesce(n, 0)::bigint as n_shingles, min(other) as component_id
from documents left join sizes using (doc_id) left join reached on reached.id = documents.doc_id
group by documents.doc_id, n
"""

_CONTROL = "(### (?:User|Assistant|System|=)|</turn>)"

_OP3 = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), doubled as (
    select *, regexp_replace(text, '(\\{{2,}})', '\1\1', 'g') as t1 from turns
), before_control as (
    select *, regexp_replace(regexp_replace(t1, '(^|[^\\])\\{_CONTROL}', '\1\\\\\2', 'g'), '(^|[^\\])\\$', '\1\\\\') as t2
    from doubled
), formatted as (
    select *, length('### ' || role || ': ' || regexp_replace(t2, '{_CONTROL}', '\\\1', 'g') || '</turn>') + 1 as chars
    from before_control
)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(chars)::bigint as formatted_chars
from formatted group by conv_id
"""

_OP5 = rf"""
with split as (
    select doc_id, coalesce(text, '') as body, {_WORDS} as w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
    from documents
), windows as (
    select doc_id, unnest(range(len(w) - 7)) as pos, w from split where len(w) >= 8
), placed as (
    select doc_id, pos, count(*) over (partition by doc_id, list_slice(w, pos + 1, pos + 8)) as n from windows
), covered as (
    select doc_id, count(distinct pos + step) as n_repeat_words
    from placed, range(8) as steps(step) where n > 1 group by doc_id
), measured as (
    select split.doc_id, len(w) as n_words, length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) as n_symbols,
        len(lines) - len(list_distinct(lines)) as n_dup_lines, len(lines) as n_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words,
        length(regexp_replace(body, '\P{{Lu}}', '', 'g')) as n_capitals
    from split left join covered using (doc_id)
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 10 * n_symbols > n_words
        or 100 * n_dup_lines > 30 * n_lines or 100 * n_capitals > 40 * word_chars or word_chars > 20 * n_words) as kept
from measured
"""

_OP6 = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: try_cast(floor(1024 * x::double) as bigint)) as parts from embeddings
    where vec_id is not null and embedding is not null
), scored as (
    select q.vec_id as query_id, c.vec_id,
        coalesce(list_sum(list_transform(list_zip(q.parts, c.parts), lambda z: z[1]::hugeint * z[2])), 0) as score
    from (select * from whole where len(list_filter(parts, lambda x: x is null)) = 0) q
    join (select * from whole where len(list_filter(parts, lambda x: x is null)) = 0) c on q.vec_id <> c.vec_id
    where q.vec_id % 100 = 0
), fitting as (
    select query_id, vec_id, least(greatest(score, -9223372036854775808), 9223372036854775807)::bigint as score from scored
)
select query_id, rank::int as rank, vec_id, score from (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from fitting
) where rank <= 10
"""

_OP8 = rf"""
with sized as (
    select doc_id, source, len({_WORDS})::hugeint as size,
        md5(coalesce(doc_id::varchar, '') || '/' || md5(coalesce(text, ''))) as place from documents
), by_source as (
    select source, sum(size)::hugeint as source_size from sized group by source
), weighed as (
    select *, [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight from by_source
), filling as (
    select *, row_number() over fill as nth,
        150 * sum(source_size) over () - 200 * coalesce(sum(source_size) over before, 0) as rest,
        sum(weight) over () - coalesce(sum(weight) over before, 0) as weight_rest
    from weighed
    window fill as (order by source_size::double / weight, source nulls last),
        before as (order by source_size::double / weight, source nulls last rows between unbounded preceding and 1 preceding)
), first_within as (
    select nth, rest, weight_rest from filling where rest * weight <= 200 * source_size * weight_rest order by nth limit 1
), targets as (
    select source, source_size, case when filling.nth >= first_within.nth
        then (first_within.rest * weight)::double / (100 * first_within.weight_rest)::double
        else (2 * source_size)::double end as target
    from filling left join first_within on true
), placed as (
    select doc_id, size, source_size, target,
        (sum(size) over (partition by sized.source order by place, size, doc_id rows unbounded preceding))::double - size / 2.0
            as middle
    from sized join targets on sized.source is not distinct from targets.source
)
select doc_id, size::bigint as size, source_size::bigint as source_size, target,
    (size * ((middle <= target)::int + (middle + source_size <= target)::int))::bigint as taken
from placed
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_join": _OP2, "op3_chat_format": _OP3, "op5_quality_rules": _OP5, "op6_topk_search": _OP6, "op8_mixing": _OP8,
    }
