"""The numbered queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    collocations,
    embedding_dedup,
    graph_ann,
    hard_negatives,
    jaccard_join,
    langid,
    licenses,
    lm_score,
    mixing,
    packing,
    pii,
    suffix_dedup,
    warc,
)
from shelfwise.llm.textops import crc_fold, small_batches


#: ``public_tokenizers.PATTERN`` in the terms of ``re``.
LATIN_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)


#: The date of the crawl that ``pages`` stands for.
CRAWL_DATE = "2024-01-01T00:00:00Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_ann.search(
        graph_ann.build_index(vectors), vectors.filter(graph_ann.query_rows(vectors))
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages"), CRAWL_DATE))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(langid.learned_rows(docs)))
    scored = langid.predict(docs.select("doc_id", "text"), model)
    held_out = (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out")
    return scored.select("doc_id", held_out, "lang_pred", "score")


def byte_bpe() -> packing.TokenizerSpec:
    return packing.TokenizerSpec(
        public_tokenizers.path("byte_bpe_50k.json"), 0, public_tokenizers.PATTERN, LATIN_PATTERN
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe())


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = lm_score.held_out(F.col("doc_id"))
    model = lm_score.train(docs.filter(~held_out), lm_score.LmParams(order=3))
    return lm_score.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).drop("text", "detections")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).drop("text")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = pii.all_spans(found)
    n_base = sum((F.size(k) for k in pii.KINDS), F.lit(0))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.span_text(F.slice(spans, F.lit(1), n_base)).cast("binary"), 256).alias("base_sha256"),
        pii.span_text(spans).alias("spans"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    cleaned = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    spans = F.coalesce("spans", F.array().cast(cleaned.schema["spans"].dataType))
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return cleaned.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {"op1_packing": op1_packing, "op2_jaccard_join": op2_jaccard_join, "op3_lm_score": op3_lm_score, "op4_licenses": op4_licenses, "op5_embedding_dedup": op5_embedding_dedup, "op6_mixing": op6_mixing, "op7_pii": op7_pii, "op8_graph_ann": op8_graph_ann, "op9_warc": op9_warc, "op10_language_id": op10_language_id, "op11_collocations": op11_collocations, "op12_suffix_dedup": op12_suffix_dedup, "op13_hard_negatives": op13_hard_negatives}


def _replaced(text: str, *steps: tuple[str, str]) -> str:
    for pattern, by in steps:
        quoted = [x.replace("'", "''") for x in (pattern, by)]
        # Line ends and quotes are written as themselves.
        text = f"regexp_replace({text}, '{quoted[0]}', '{quoted[1]}', 'g')"
    return text


def _urn(seed: str) -> str:
    h = f"md5({seed})"
    parts = ", ".join(f"substr({h}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || concat_ws('-', {parts}) || '>'"


def _decoded(text: str) -> str:
    """Character references replaced in one pass; ``names`` is a column with those by name."""
    number = "ltrim(n[2:], '0')"
    digits = f"(case when n[2] in ('x', 'X') then (case when length(ltrim(n[3:], '0')) > 7 then '9999999999' else coalesce(try_cast('0x0' || ltrim(n[3:], '0') as bigint), 0)::varchar end) else {number} end)"
    code = f"(case when length({digits}) <= 9 then ('0' || {digits})::bigint else 0 end)"
    real = f"{code} > 0 and {code} <= 1114111 and not {code} between 55296 and 57343"
    character = (
        f"case when n[1] = '#' then case when {real} then coalesce(names['#' || {code}], chr({code}::integer)) "
        f"else '{warc.NO_CHARACTER}' end else coalesce(names[n], '&' || n || ';') end"
    )
    pieces = f"string_split_regex({text}, '{warc.REFERENCE}')"
    found = f"list_transform(regexp_extract_all({text}, '{warc.REFERENCE}', 1), lambda n: {character})"
    joined = f"array_to_string(list_transform(list_zip({pieces}, {found}), lambda p: p[1] || coalesce(p[2], '')), '')"
    return f"case when contains({text}, '&') then {joined} else {text} end"


def _map(values: dict[str, str]) -> str:
    quoted = [", ".join("'" + x.replace("'", "''") + "'" for x in part) for part in (values, values.values())]
    return f"map([{quoted[0]}], [{quoted[1]}])"


def warc_sql() -> str:
    one_line = "regexp_replace({}, '[\r\n]+', ' ', 'g')"
    untagged = _replaced("payload", warc.COMMENT, *warc.TAG_STEPS)
    title = "regexp_extract(payload, '(?is)<title[^>]*>(.*?)</title>', 1)"
    title = _replaced(title, *warc.TAG_STEPS[2:])
    links = "regexp_extract_all(payload, '" + warc.LINK.replace("'", "''") + "')"
    links = f"list_transform({links}, lambda x: {_replaced('x', *warc.LINK_STEPS)})"
    link = f"'outlink: ' || {one_line.format('x')} || crlf"
    header = " || ".join(
        f"'{name}: ' || {value} || crlf"
        for name, value in (
            ("WARC-Type", "warc_type"),
            ("WARC-Record-ID", "record_id"),
            ("WARC-Date", "warc_date"),
            ("WARC-Target-URI", "target_uri"),
            ("WARC-Refers-To", "refers_to"),
            ("WARC-Concurrent-To", "concurrent_to"),
            ("WARC-Source-Digest", "source_digest"),
            ("WARC-Block-Digest", "block_digest"),
            ("Content-Type", "content_type"),
            ("Content-Length", "content_length::varchar"),
        )
    )
    return f"""
with response as materialized (
    select page_id, coalesce(html, '') as payload, chr(13) || chr(10) as crlf,
        {one_line.format("coalesce(url, '')")} as target_uri,
        {_urn("'response ' || coalesce(page_id::varchar, '') || ' ' || coalesce(url, '')")} as refers_to
    from pages
), untagged as materialized (
    select *, {untagged} as raw_text, {title} as raw_title, {_map(warc.named_characters())} as names from response
), decoded as materialized (
    select *, {_decoded("raw_text")} as text, {_decoded("raw_title")} as one_title from untagged
), readable as materialized (
    select page_id, crlf, target_uri, refers_to,
        'sha256:' || sha256(payload) as source_digest,
        trim({_replaced("text", *warc.SPACE_STEPS)}, ' ' || chr(10)) as plain,
        trim({_replaced("one_title", *warc.ONE_LINE)}) as title,
        array_to_string(list_transform({links}, lambda x: {link}), '') as outlinks,
        strlen(payload) as bytes,
        {_urn("'metadata ' || refers_to")} as metadata_id,
        {_urn("'conversion ' || refers_to")} as conversion_id
    from decoded
), both_kinds as (
    select *, 'metadata' as warc_type, metadata_id as record_id, conversion_id as concurrent_to,
        'application/warc-fields' as content_type,
        'source-header: HTTP/1.1 200 OK' || crlf
        || 'source-header: Content-Type: text/html; charset=utf-8' || crlf
        || 'source-header: Content-Length: ' || bytes || crlf
        || 'source-digest: ' || source_digest || crlf || 'title: ' || title || crlf
        || 'text-length: ' || length(plain) || crlf || outlinks as block
    from readable
    union all
    select *, 'conversion', conversion_id, metadata_id, 'text/plain; charset=utf-8', plain
    from readable
), digested as (
    select *, '{CRAWL_DATE}' as warc_date, 'sha256:' || sha256(block) as block_digest,
        strlen(block)::bigint as content_length
    from both_kinds
)
select page_id, refers_to, target_uri, warc_date, source_digest, warc_type, record_id,
    concurrent_to, content_type, block, block_digest, content_length,
    'WARC/1.1' || crlf || {header} as header
from digested
"""


COLLOCATIONS_SQL = """
with pieces as materialized (
    select coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^ \t]+') as w
    from (
        select lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\n\x0b\f\r]'
        )) as piece
        from documents
    )
), totals as (
    select lang, sum(len(w))::bigint as n from pieces group by lang
), counts as materialized (
    select lang, k, phrase, count(*) as a
    from (
        select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
        from (
            select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
            from pieces, (select unnest(range(1, 6)) as k)
        )
    )
    group by lang, k, phrase
    having count(*) >= 100
), longer as (
    select lang, unnest([array_to_string(w[: k - 1], ' '), array_to_string(w[2 :], ' ')]) as phrase, a
    from (select lang, k, string_split(phrase, ' ') as w, a from counts where k > 2)
), inside as (
    select lang, phrase, max(a) as most from longer group by lang, phrase
), cuts as (
    select lang, k, phrase, a, j,
        array_to_string(string_split(phrase, ' ')[: j], ' ') as left_part,
        array_to_string(string_split(phrase, ' ')[j + 1 :], ' ') as right_part
    from (
        select c.lang, c.k, c.phrase, c.a, unnest(range(1, c.k)) as j
        from counts c left join inside i on c.lang = i.lang and c.phrase = i.phrase
        where c.k > 1 and (i.most is null or 100 * i.most < 100 * c.a)
    )
), scored as (
    select c.lang, c.phrase, c.a, x.a as l, y.a as r, t.n, c.j,
        ((1000::hugeint * c.a * t.n) // (x.a::hugeint * y.a))::bigint as score
    from cuts c
    join counts x on c.lang = x.lang and c.left_part = x.phrase
    join counts y on c.lang = y.lang and c.right_part = y.phrase
    join totals t on c.lang = t.lang
), lowest as (
    select * from scored
    qualify row_number() over (partition by lang, phrase order by score, j) = 1
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
    phrase, a, l, r, n, score
from lowest
qualify rank <= 2000
"""

NEGATIVES_SQL = """
with rows_in as materialized (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as materialized (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
        list_inner_product(a.v, b.v)::bigint as score
    from rows_in a join rows_in b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id,
    row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::integer as rank,
    vec_id as negative_id, positive_score, score as negative_score
from positives p join scores s
    on p.anchor_id = s.anchor_id and not s.same
    and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""


ORACLE: dict[str, str] = {
    "op9_warc": warc_sql(),
    "op11_collocations": COLLOCATIONS_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
