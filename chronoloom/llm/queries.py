"""The thin queries over the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm import bpe, html, importance, licenses, media, mixing, oracles, prefix_bpe, prefix_trie, quality, rans, sharding, simhash, warc
from chronoloom.llm.common import materialize, new_path, words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.size(words(F.col("text"))).cast("bigint").alias("size"))
    mixed = mixing.with_places(mixing.mix(materialize(docs, "mix-sizes")))
    both = lambda name: F.filter(F.array(f"{name}_0", f"{name}_1"), lambda x: x.isNotNull())
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("taken_0") + F.col("taken_1")).alias("taken"), both("shard").alias("shards"), both("place").alias("places"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write(table(spark, sf_dir, "pages"))
    located = warc.locate(warc.build_index(written), written.select("key"))
    return warc.fetch(located, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_png_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.store(table(spark, sf_dir, "documents")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = rans.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49_408)
    return rans.read(spark, folder)


#: Arrivals that the sharding query appends.
ARRIVALS = 4


def op9_shard_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "shards")
    arrivals = table(spark, sf_dir, "documents").withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)))
    sharding.append(spark, arrivals, root, "batch")
    sharding.compact(spark, root)
    rows = sharding.read(spark, root)
    return rows.select("doc_id", "source", "n_chars", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.col("_shard").alias("shard"), F.col("_row").alias("shard_row"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = prefix_bpe.read_model(public_tokenizers.path("byte_bpe_50k.json"))
    return prefix_bpe.round_trip(table(spark, sf_dir, "documents"), model, public_tokenizers.PATTERN)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_trie.placed(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_shared_heads(rows))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_mix_sources": op2_mix_sources,
        "op3_html_text": op3_html_text,
        "op4_warc_index": op4_warc_index,
        "op5_simhash": op5_simhash,
        "op6_png_media": op6_png_media,
        "op7_quality_rules": op7_quality_rules,
        "op8_token_files": op8_token_files,
        "op9_shard_compaction": op9_shard_compaction,
        "op10_license_scan": op10_license_scan,
        "op11_prefix_bpe": op11_prefix_bpe,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_importance": op13_importance,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_warc_index": oracles.OP4, "op7_quality_rules": oracles.OP7, "op12_prefix_trie": oracles.OP12, "op13_importance": oracles.OP13}
