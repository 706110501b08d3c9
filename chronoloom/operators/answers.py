"""Answers of language models, grades of what was detected, models for languages, and masks for what must not be shown."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.operators.folding import BLANKS

#: Keys under which a nested answer holds its text; seconds of sound that a language detector needs.
TEXT_KEYS = ("text", "translation", "english_text")
DETECTION_WINDOW, LEAST_PROBABILITY = 30.0, 0.5
#: What the blank pipeline can do.
FALLBACK_CAPABILITIES = "tokenize,sentences"
#: Names of secrets, of what holds a secret's name, words before a secret in a command, and the mask.
SECRET = r"(?i)(api[_-]?key|token|secret|password|authorization|access[_-]?key)"
HOLDER = r"(?i)(_env|_var|_variable|_env_var)$"
SECRET_FLAG = r"(?i)(token|key|secret|password)$"
MASK = "***masked***"


def message_content(response: Column) -> Column:
    """The text of a chat response in JSON as it stands, or its content parts put together; null if it is blank or none."""
    content = F.try_variant_get(F.try_parse_json(response), "$.choices[0].message.content", "variant")
    parts = F.try_variant_get(content, "$", "array<variant>")
    joined = F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit(""))), "")
    kind = F.schema_of_variant(content)
    text = F.when(kind.startswith("ARRAY"), joined).when(kind == "STRING", F.try_variant_get(content, "$", "string"))
    return F.when(F.length(F.btrim(text, F.lit(BLANKS))) > 0, text)


def fenced_json(text: Column) -> Column:
    """The JSON of an answer as a VARIANT, with or without a fence; else what stands between its outer braces. Null if neither parses."""
    bare = F.btrim(text, F.lit(BLANKS))
    inside = F.btrim(F.regexp_replace(F.btrim(bare, F.lit("`")), "(?i)^json", ""), F.lit(BLANKS))
    bare = F.when(bare.startswith("```"), inside).otherwise(bare)
    return F.coalesce(F.try_parse_json(bare), F.try_parse_json(F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit(""))))


def translations(rows: DataFrame, keys: list[str], answer: str) -> DataFrame:
    """(keys, id, text, problem): the entries of {id: text}, trimmed, or of {id: {text: ...}} by the first of TEXT_KEYS that says
    something. An answer that is no JSON, no object, or has a null is refused as a whole: one row with the problem and no text."""
    parsed = rows.select(*keys, fenced_json(F.col(answer)).alias("_v"))
    entries = F.map_entries(F.try_variant_get("_v", "$", "map<string,variant>"))

    def own(value: Column) -> Column:
        asked = [F.try_variant_get(value, f"$.{k}", "string") for k in TEXT_KEYS]
        said = F.coalesce(*[F.nullif(x, F.lit("")) for x in asked], asked[-1])
        text = F.when(F.schema_of_variant(value).startswith("OBJECT"), said).otherwise(F.try_variant_get(value, "$", "string"))
        return F.btrim(text, F.lit(BLANKS))

    # A problem comes first, and alone.
    found = F.transform(entries, lambda e: F.struct(e["key"].alias("id"), own(e["value"]).alias("text")))
    empty = F.filter(found, lambda e: e["text"].isNull())
    problem = F.when(F.col("_v").isNull(), "not JSON").when(~F.schema_of_variant("_v").startswith("OBJECT"), "not an object").when(F.size(empty) > 0, "null translation")
    refused = F.array(F.struct(F.when(F.size(empty) > 0, F.get(empty, F.lit(0))["id"]).alias("id"), F.lit(None).cast("string").alias("text")))
    told = parsed.select(*keys, problem.alias("problem"), F.explode(F.when(problem.isNotNull(), refused).otherwise(found)).alias("e"))
    return told.select(*keys, "e.id", "e.text", "problem")


def strict_number(value: Column) -> Column:
    """A VARIANT's number, or that of a string that holds one; flags and other kinds are null."""
    kind = F.schema_of_variant(value)
    return F.when(~kind.rlike("^(BOOLEAN|OBJECT|ARRAY|VOID)"), value.try_cast("string").try_cast("double"))


def label_list(value: Column) -> Column:
    """The texts of a value that is a JSON list of two or more; null for any other."""
    found = F.from_json(value, "array<string>")
    return F.when(F.ltrim(value).startswith("[") & (F.size(found) > 1), found)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds between two ISO-8601 times, three decimals; null if either is none."""
    micros = lambda c: F.unix_micros(c.try_cast("timestamp"))
    return F.round((micros(end) - micros(start)) / 1e6, 3)


def axis(media_seconds: Column, latest: Column) -> Column:
    """(seconds, basis): the media's length, or the latest end where that is unknown or exceeded."""
    over = F.coalesce(latest > media_seconds, F.lit(False))
    basis = F.when(media_seconds.isNull() | (media_seconds <= 0), "latest end").when(over, "media, widened").otherwise("media")
    return F.struct(F.when(basis == "media", media_seconds).otherwise(F.coalesce(latest, F.lit(0.0))).alias("seconds"), basis.alias("basis"))


def content_hash(columns: list[str], length: int = 16) -> Column:
    """The first hexadecimal digits of a hash of a row's named values, in the order of the names."""
    return F.substring(F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256), 1, length)


def language_grade(seconds: Column, probability: Column, explicit: Column) -> Column:
    """(status, reasons) of a language: configured, low (short sound, unknown or small probability) or ok."""
    reasons = F.filter(
        F.array(
            F.when(seconds < DETECTION_WINDOW, F.concat(F.lit("audio is "), F.format_string("%.1f", seconds), F.lit(f"s, below the {DETECTION_WINDOW:.0f}s detection window"))),
            F.when(probability.isNull(), F.lit("detection probability unavailable")).when(probability < LEAST_PROBABILITY, F.concat(F.lit("detection probability "), F.format_string("%.2f", probability))),
        ),
        lambda x: x.isNotNull(),
    )
    nothing = F.array().cast("array<string>")
    return F.when(explicit.isNotNull() & (explicit != ""), F.struct(F.lit("configured").alias("status"), nothing.alias("reasons"))).otherwise(F.struct(F.when(F.size(reasons) > 0, "low").otherwise("ok").alias("status"), reasons.alias("reasons")))


def trusted_language(language: Column, status: Column, trust_low: bool = False) -> Column:
    """The language, or none where its grade is low and low grades are not trusted."""
    return F.when((status == "low") & F.lit(not trust_low), F.lit(None)).otherwise(language)


def resolve_models(languages: DataFrame, language: str, configured: DataFrame, installed: DataFrame, fallback: str = "blank") -> DataFrame:
    """languages with language_key, model, requested_model, status and capabilities.

    The configured model if it is installed, another of its family, one found by the language's name, else the fallback.
    configured (language, model) and installed (model) are short lists of a site; the languages are one row each after
    distinct(), so the joins are small whatever the table holds.
    """
    key = F.coalesce(F.nullif(F.lower(F.trim(language)), F.lit("")), F.lit("und"))
    asked = languages.select(key.alias("language_key")).distinct()
    family = F.split("model", "_")[0]
    first = installed.groupBy(family.alias("_family")).agg(F.min("model").alias("_first"))
    wanted = asked.join(configured.select(F.col("language").alias("language_key"), F.col("model").alias("requested_model")), "language_key", "left")
    wanted = wanted.join(installed.select(F.col("model").alias("requested_model"), F.lit(True).alias("_there")).distinct(), "requested_model", "left")
    wanted = wanted.withColumn("_family", F.coalesce(F.split("requested_model", "_")[0], "language_key")).join(first, "_family", "left")
    has, found = F.col("requested_model").isNotNull(), F.col("_first").isNotNull()
    status = F.when(F.col("_there"), "configured").when(has & found, "substituted_family").when(has, "fallback_missing_model").when(found, "discovered").otherwise("fallback_no_model")
    chosen = wanted.withColumn("status", status).withColumn("model", F.when(F.col("status") == "configured", F.col("requested_model")).when(F.col("status").startswith("fallback"), fallback).otherwise(F.col("_first")))
    chosen = chosen.select("language_key", "model", "requested_model", "status", F.when(F.col("status").startswith("fallback"), FALLBACK_CAPABILITIES).otherwise("full").alias("capabilities"))
    return languages.withColumn("language_key", key).join(chosen, "language_key", "left")


def _is_secret(name: Column) -> Column:
    """Whether a name is that of a secret; one that holds the name of a secret's place is not."""
    return name.rlike(SECRET) & ~name.rlike(HOLDER)


def mask_secrets(values: Column, kind: T.DataType | None = None) -> Column:
    """values with what stands under secret names masked, in maps, structs and lists at any depth of their type (a map of
    strings if it is not given). Null, empty and zero stay; a value that cannot hold the mask becomes null."""
    kind = kind or T.MapType(T.StringType(), T.StringType())

    def masked(value: Column, of: T.DataType) -> Column:
        told = F.lit(MASK) if isinstance(of, T.StringType) else F.lit(None).cast(of)
        nothing = value == "" if isinstance(of, T.StringType) else value == 0 if isinstance(of, T.NumericType) else F.lit(False)
        return F.when(value.isNull() | nothing, value).otherwise(told)

    if isinstance(kind, T.MapType):
        return F.transform_values(values, lambda k, v: F.when(_is_secret(k.cast("string")), masked(v, kind.valueType)).otherwise(mask_secrets(v, kind.valueType)))
    if isinstance(kind, T.StructType):
        fields = [masked(values[f.name], f.dataType) if re.search(SECRET, f.name) and not re.search(HOLDER, f.name) else mask_secrets(values[f.name], f.dataType) for f in kind.fields]
        return F.when(values.isNotNull(), F.struct(*[x.alias(f.name) for x, f in zip(fields, kind.fields, strict=True)]))
    if isinstance(kind, T.ArrayType):
        return F.transform(values, lambda v: mask_secrets(v, kind.elementType))
    return values


def mask_command(words: Column) -> Column:
    """A command in which what follows a word that ends like a secret's name is masked, with or without dashes before that word."""
    return F.transform(words, lambda w, i: F.when(F.coalesce(F.get(words, i - 1).rlike(SECRET_FLAG), F.lit(False)), F.lit(MASK)).otherwise(w))


def provenance(rows: DataFrame, keys: list[str], table: str, facts: list[str]) -> DataFrame:
    """(keys, table, key, value): facts of a table as text, without those that are null."""
    pairs = F.filter(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in facts]), lambda x: x["value"].isNotNull())
    return rows.select(*keys, F.lit(table).alias("table"), F.explode(pairs).alias("p")).select(*keys, "table", "p.key", "p.value")
