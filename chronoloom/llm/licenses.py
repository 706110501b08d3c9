"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Texts and templates become lower-case runs of letters and digits, then five-word shingles. For each template length
of L shingles the text is covered by windows of 1.5 L shingles, half of L apart, so every occurrence lies inside one
window. A window that holds 0.8 of a template has a Jaccard similarity of at least 0.8 L / (1.5 L + 0.2 L) = 0.47. Its
signature has BANDS bands of ROWS minima each; template and window meet if a band agrees, so a pair at that least
similarity is missed with probability (1 - 0.47 ** 2) ** 40 < 5e-5, and one that holds the whole template (0.67) with
(1 - 0.67 ** 2) ** 40 < 1e-10. Only windows with a shingle of some template of their length get a signature: others agree
with none in any band, so this loses nothing. Pairs that meet are verified on the shingles themselves: at least 0.8 of
the template's must be in the window, and so must the words that tell its kind and version from others; clauses that
come later, up to where the same notice begins again or the text ends, decide between BSD licenses.

Only built-in functions. A text's windows never leave its row until a template is met; the templates are a parameter of
the operator, bounded by MAX_TEMPLATES, and only their bands are broadcast.

Defined results: null, empty and short texts match nothing, a text of any length is scanned whole; one row for each id
and license that some window verifies, so an empty table gives no rows; rows that share an id are scanned apart and
reported together; other columns are left out.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm.common import let, once
from chronoloom.llm.license_texts import BSD, TEMPLATES

SHINGLE, LEAST, BANDS, ROWS, MAX_TEMPLATES = 5, 0.8, 40, 2, 1000


def clauses(license: str, body: str) -> tuple[list[str], list[str], list[str]]:
    """What tells a template from its neighbours: phrases that must be in the window, that must follow it, and that must not."""
    plain = " ".join(re.findall(r"\w+", body.lower()))
    if license == "BSD-2-Clause" and body != BSD and body.startswith(BSD):
        return [], [], ["neither the name"]
    if license == "BSD-3-Clause" and body != BSD and body.startswith(BSD):
        return ["neither the name"], [], []
    if body == BSD:
        holders = "provided by the copyright holders"
        return {"BSD": ([], [], [holders, "neither the name"]), "BSD-2-Clause": ([], [holders], ["neither the name"]), "BSD-3-Clause": ([], ["neither the name"], [])}[license]
    # What the template says of kind and version, word for word.
    said = re.findall(r"gnu (?:lesser |affero )?general public license|(?:version|v) \d\b(?: \d\b)?|creative commons attribution(?: \w+)*? [34] 0|cc by(?: \w\w)* [34] 0", plain)
    if license == "GPL-3.0" and "version" not in plain:
        return said, [], ["version 2 of the license"]
    # A version of one number is not the start of a longer one.
    return said, [], ["version 2 1"] if license == "GPL-2.0" else []


def first_words(body: str) -> str:
    """The words by which a notice is known to begin again."""
    return " ".join(re.findall(r"[^\W_]+", body.lower())[:SHINGLE])


def places(found: Column, phrase: str) -> Column:
    """Every place at which a phrase begins among words."""
    own = phrase.split()
    hits = lambda i: reduce(Column.__and__, [F.get(found, i + k) == x for k, x in enumerate(own)])
    return F.filter(F.sequence(F.lit(0), F.size(found)), lambda i: F.coalesce(hits(i), F.lit(False)))


def license_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingle_hashes(found: Column) -> Column:
    last = F.size(found) - SHINGLE
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(SHINGLE)]))
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(hashes)


def shingles(found: Column) -> Column:
    last = F.size(found) - SHINGLE
    texts = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", *[F.get(found, i + k) for k in range(SHINGLE)]))
    return F.array_distinct(F.when(last < 0, F.array().cast("array<string>")).otherwise(texts))


def band_keys(hashes: Column) -> Column:
    """One key for each band: its number with the minima of ROWS seeded hashes."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*[F.xxhash64(F.lit(band), *[least(band * ROWS + k) for k in range(ROWS)]) for band in range(BANDS)])


def far_phrases(templates: list[tuple[str, str]]) -> list[str]:
    """Phrases whose places in a text decide between templates: later clauses, and the beginnings of what has such."""
    out = [x for name, body in templates for _, after, never in [clauses(name, body)] if after or never for x in [first_words(body), *after, *never]]
    return list(dict.fromkeys(out))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, within, head, after, never, hashes, shingles, length), of templates that have a shingle; head, after and
    never count the phrases of far_phrases."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    number = {x: i for i, x in enumerate(far_phrases(templates))}

    def facts(template: int, name: str, body: str) -> dict:
        within, after, never = clauses(name, body)
        return {"template": template, "license": name, "body": body, "within": [f" {x} " for x in within], "head": number.get(first_words(body)), "after": [number[x] for x in after], "never": [number[x] for x in never]}

    # One literal, whatever the number of templates.
    kind = "array<struct<template:int,license:string,body:string,within:array<string>,head:int,after:array<int>,never:array<int>>>"
    listed = F.from_json(F.lit(json.dumps([facts(i, name, body) for i, (name, body) in enumerate(templates)])), kind)
    rows = spark.range(1).select(F.inline(listed)).withColumn("w", license_words(F.col("body")))
    rows = rows.select("template", "license", "within", "head", "after", "never", shingle_hashes(F.col("w")).alias("hashes"), shingles(F.col("w")).alias("shingles"))
    return rows.withColumn("length", F.size("shingles")).where("length > 0")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(id_col, license, containment, n_windows, first_word): licenses verified in each text."""
    spark = docs.sparkSession
    known = template_table(spark, templates)
    # Templates are few and bounded, so their lengths and shingle hashes become literals of the plan.
    held: dict[int, set[int]] = {}
    for row in known.select("length", "hashes").collect():
        held.setdefault(row["length"], set()).update(row["hashes"])

    rows = once(docs.select(F.col(id_col), F.col(text_col)), _w=license_words(F.col(text_col)))
    rows = once(rows.select(id_col, "_w"), _h=shingle_hashes(F.col("_w")))
    # The few places whose shingle any template has: windows are cut around those alone.
    def one_of(hashes: set[int]) -> str:
        """As text: a list of thousands of literals is one call."""
        return f"coalesce(get(_h, i) IN ({', '.join(f'{h}L' if h > -(2**63) else 'null' for h in sorted(hashes)) or 'null'}), false)"

    hits = F.expr(f"filter(sequence(0, size(_h)), i -> {one_of(set().union(*held.values()))})")
    rows = once(rows, _hits=hits).where(F.size("_hits") > 0)

    def windows(length: int) -> Column:
        step, width = max(1, length // 2), length + -(-length // 2)
        own = F.expr(f"filter(_hits, i -> {one_of(held[length])})")
        around = F.transform(own, lambda i: F.sequence(F.greatest(F.lit(0), F.ceil((i - width + 1) / step)), F.floor(i / step)))
        starts = F.array_distinct(F.flatten(around))
        return F.transform(starts, lambda k: F.struct(F.lit(length).alias("length"), (k * step).cast("int").alias("first_word"), F.slice("_h", (k * step).cast("int") + 1, width).alias("hashes")))

    spans = F.concat(*[windows(n) for n in sorted(held)]) if held else F.array().cast("array<struct<length:int,first_word:int,hashes:array<bigint>>>")
    far = F.array(*[places(F.col("_w"), x) for x in far_phrases(templates)]).cast("array<array<int>>")
    rows = once(rows.select(id_col, "_w", "_h", "_hits"), _far=far)
    cut = rows.select(id_col, "_w", "_far", F.explode_outer(spans).alias("x")).where("x is not null")
    span = F.slice("_w", F.col("x.first_word") + 1, F.size("x.hashes") + SHINGLE - 1)
    cut = once(cut.select(id_col, "x.length", "x.first_word", "x.hashes", span.alias("span"), "_far"), bands=band_keys(F.col("hashes")))
    # At most MAX_TEMPLATES rows of BANDS keys.
    sketches = F.broadcast(known.select("length", "template", "license", "within", "head", "after", "never", "shingles", band_keys(F.col("hashes")).alias("sketch")))
    met = cut.join(sketches, "length").where(F.arrays_overlap("bands", "sketch"))
    share = let(shingles(F.col("span")), lambda s: F.size(F.array_intersect(s, F.col("shingles"))) / F.size(F.col("shingles")))
    verified = once(met, containment=share).where(F.col("containment") >= least)
    again = F.array_min(F.filter(F.get("_far", F.col("head")), lambda x: x >= F.col("first_word") + F.size("hashes")))
    verified = once(verified, _near=F.concat(F.lit(" "), F.array_join("span", " "), F.lit(" ")), _until=F.coalesce(again, F.lit(2**31 - 1)))
    follows = lambda n: F.exists(F.get("_far", n), lambda x: (x >= F.col("first_word")) & (x < F.col("_until")))
    verified = verified.where(F.forall("within", lambda x: F.col("_near").contains(x)) & F.forall("after", follows) & ~F.exists("never", follows))
    return verified.groupBy(id_col, "license").agg(
        F.max("containment").alias("containment"), F.count("*").alias("n_windows"), F.min("first_word").cast("bigint").alias("first_word")
    )
