"""Queries over texts, dialogues, names and table quality, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.operators import quality, text
from chronoloom.plans.registry import register
from chronoloom.sources.tables import table


@register(
    "word_fallback",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^ \t\n\r]+|[ \t\n\r]+') AS p FROM documents), e AS (SELECT doc_id, unnest(p) AS word, generate_subscripts(p, 1) AS i FROM w),
    o AS (SELECT doc_id, i, word, sum(length(word)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM e)
    SELECT doc_id, printf('%d-w%05d', doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i)) AS word_id, word, (e - length(word))::BIGINT AS character_start, e::BIGINT AS character_end FROM o WHERE NOT regexp_matches(word, '^[ \t\n\r]')""",
)
def word_fallback(spark, sf_dir):
    return text.fallback_words(table(spark, sf_dir, "documents"), "doc_id", "text").withColumns({c: F.col(c).cast("bigint") for c in ("character_start", "character_end")})


@register(
    "sentence_tokens",
    r"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])[ \t\n\r]+', '\1' || chr(1), 'g'), chr(1)), lambda x: length(x) > 0) AS p FROM documents), e AS (SELECT doc_id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM s)
    SELECT doc_id, printf('%d-s%03d', doc_id, i) AS sentence_id, x AS text, len(regexp_extract_all(x, '[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r]'))::BIGINT AS token_count FROM e""",
)
def sentence_tokens(spark, sf_dir):
    return text.sentences(table(spark, sf_dir, "documents"), "doc_id", "text")


@register(
    "word_shape",
    r"""WITH w AS (SELECT unnest(regexp_extract_all(text, '[^ \t\n\r]+')) AS w FROM documents),
    s AS (SELECT replace(regexp_replace(regexp_replace(regexp_replace(w, '\p{Lu}', chr(1), 'g'), '\p{L}', 'x', 'g'), '\p{Nd}', 'd', 'g'), chr(1), 'X') AS s FROM w)
    SELECT CASE WHEN length(s) > 12 THEN substr(s, 1, 12) || '…' ELSE s END AS shape, count(*) AS words FROM s GROUP BY 1""",
)
def word_shape(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[^ \t\n\r]+"), F.lit(0))).alias("w"))
    return words.groupBy(text.word_shape(F.col("w")).alias("shape")).agg(F.count("*").alias("words"))


@register(
    "slug_ids",
    r"""WITH p AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '^.*/', ''), '\.[A-Za-z0-9]+$', '') AS stem FROM pages),
    s AS (SELECT page_id, url, regexp_replace(substr(regexp_replace(regexp_replace(stem, '[^A-Za-z0-9_-]+', '_', 'g'), '^[_-]+|[_-]+$', '', 'g'), 1, 80), '[_-]+$', '') AS s FROM p),
    n AS (SELECT page_id, url, CASE WHEN length(s) > 0 THEN s ELSE 'video' END AS s FROM s)
    SELECT page_id, url, CASE WHEN count(*) OVER (PARTITION BY lower(s)) > 1 THEN s || '-' || substr(sha256(url), 1, 8) ELSE s END AS video_id FROM n""",
)
def slug_ids(spark, sf_dir):
    return text.unique_slugs(table(spark, sf_dir, "pages").select("page_id", "url"), "url")


@register(
    "llm_batches",
    r"""WITH l AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rn, turn || ' ' || role || ': ' || text AS line FROM conversations),
    b AS (SELECT DISTINCT conv_id, rn // 3 AS batch FROM l)
    SELECT b.conv_id, b.batch, count(*) FILTER (rn // 3 = batch) AS rows, coalesce(string_agg(line, chr(10) ORDER BY rn) FILTER (rn < batch * 3), '') AS "before", string_agg(line, chr(10) ORDER BY rn) FILTER (rn // 3 = batch) AS body,
      coalesce(string_agg(line, chr(10) ORDER BY rn) FILTER (rn >= batch * 3 + 3), '') AS "after",
      substr(sha256(coalesce(string_agg(line, chr(10) ORDER BY rn) FILTER (rn < batch * 3), '') || chr(1) || string_agg(line, chr(10) ORDER BY rn) FILTER (rn // 3 = batch) || chr(1) || coalesce(string_agg(line, chr(10) ORDER BY rn) FILTER (rn >= batch * 3 + 3), '')), 1, 16) AS request_key
    FROM b JOIN l ON l.conv_id = b.conv_id AND l.rn >= b.batch * 3 - 1 AND l.rn < b.batch * 3 + 4 GROUP BY ALL""",
)
def llm_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    line = F.concat(F.col("turn").cast("string"), F.lit(" "), F.col("role"), F.lit(": "), F.col("text"))
    return text.batches(rows, ["conv_id"], "turn", line, 3, 1)


@register(
    "translate_mock",
    """SELECT conv_id, turn, role AS speaker, text AS source_text, CASE WHEN length(trim(text)) > 0 THEN '[en] ' || text END AS english_text, 'mock' AS translation_model FROM conversations""",
)
def translate_mock(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    answers = rows.where(F.length(F.trim("text")) > 0).select("conv_id", "turn", F.concat(F.lit("[en] "), "text").alias("english_text"))
    return rows.join(answers, ["conv_id", "turn"], "left").select("conv_id", "turn", F.col("role").alias("speaker"), F.col("text").alias("source_text"), "english_text", F.lit("mock").alias("translation_model"))


@register(
    "stories_mock",
    """WITH s AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rn FROM conversations),
    w AS (SELECT conv_id, rn // 4 AS w, count(*) AS n, min(turn) AS first_turn, max(turn) AS last_turn, list(turn ORDER BY turn) AS t FROM s GROUP BY ALL)
    SELECT conv_id, CASE WHEN n >= 2 THEN 'w' || w || '-s1' END AS story_id, first_turn, last_turn, CASE WHEN n >= 2 THEN '["' || array_to_string(t, '","') || '"]' END AS evidence_segment_ids, CASE WHEN n < 2 THEN 'fewer than two segments' END AS no_story_reason FROM w""",
)
def stories_mock(spark, sf_dir):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.floor(place / 4).alias("w"))
    windows = rows.groupBy("conv_id", "w").agg(F.count("*").alias("n"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.sort_array(F.collect_list("turn")).alias("t"))
    told = F.col("n") >= 2
    return windows.select(
        "conv_id", F.when(told, F.concat(F.lit("w"), F.col("w").cast("string"), F.lit("-s1"))).alias("story_id"), "first_turn", "last_turn",
        F.when(told, F.to_json(F.col("t").cast("array<string>"))).alias("evidence_segment_ids"), F.when(~told, "fewer than two segments").alias("no_story_reason"),
    )


@register("json_normalise", """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, json_type(props, '$.k') IN ('BIGINT', 'UBIGINT', 'DOUBLE') AS is_number FROM events""")
def json_normalise(spark, sf_dir):
    value = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    kind = F.schema_of_variant(F.expr("try_variant_get(try_parse_json(props), '$.k', 'variant')"))
    return table(spark, sf_dir, "events").select("event_id", value.try_cast("bigint").alias("k"), kind.rlike("^(BIGINT|DOUBLE|DECIMAL)").alias("is_number"))


@register(
    "quality_report",
    """SELECT 'large_quantity' AS rule, l_orderkey::VARCHAR AS key FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT 'high_discount', l_orderkey::VARCHAR FROM lineitem WHERE l_discount > 0.09
    UNION ALL SELECT DISTINCT 'unlabelled_document', doc_id::VARCHAR FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'repeated_customer', o_custkey::VARCHAR FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
)
def quality_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    rows = quality.violations(lines, "l_orderkey", {"large_quantity": F.col("l_quantity") > 45, "high_discount": F.col("l_discount") > 0.09})
    return quality.together(
        rows, quality.unresolved(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id", "unlabelled_document"), quality.repeated(table(spark, sf_dir, "orders"), "o_custkey", "repeated_customer")
    )


@register(
    "status_rollup",
    """SELECT l_orderkey AS video_id, CASE WHEN bool_or(l_linestatus = 'O' AND l_returnflag = 'N') THEN 'running' WHEN bool_or(l_returnflag = 'R') THEN CASE WHEN bool_or(l_returnflag = 'A') THEN 'partial' ELSE 'failed' END WHEN bool_and(l_linestatus = 'F') THEN 'completed' ELSE 'pending' END AS status,
    count(*) AS stages, round(sum(l_quantity), 2) AS seconds, coalesce(array_to_string(list_sort(list(l_linenumber) FILTER (l_returnflag = 'R')), ','), '') AS failed_stages FROM lineitem GROUP BY 1""",
)
def status_rollup(spark, sf_dir):
    returned = F.col("l_returnflag") == "R"
    status = (
        F.when(F.bool_or((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")), "running")
        .when(F.bool_or(returned), F.when(F.bool_or(F.col("l_returnflag") == "A"), "partial").otherwise("failed"))
        .when(F.bool_and(F.col("l_linestatus") == "F"), "completed").otherwise("pending")
    )
    failed = F.array_join(F.sort_array(F.collect_list(F.when(returned, F.col("l_linenumber")))), ",")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("video_id")).agg(status.alias("status"), F.count("*").alias("stages"), F.round(F.sum("l_quantity"), 2).alias("seconds"), failed.alias("failed_stages"))
