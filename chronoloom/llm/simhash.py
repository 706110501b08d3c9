"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified Hamming distance, connected groups.

Fingerprints: lower-cased ASCII words, 3-word shingles with repeats, XXH64 (seed 42) of each; a bit is set if over
half of the shingles set it. Linking: 64 bits are cut into six blocks; two fingerprints that differ in at most three
bits agree on at least three blocks, so they meet under one of the twenty three-block keys. Only distinct
fingerprints are joined (exact copies are one node). Within a key the pairs are compared in the task, and what leaves
it is a spanning forest of the links, never all pairs. A key with more than CHUNK fingerprints is cut into chunks and
each pair of chunks is one unit of work, so no unit grows with the key.

Defined results: ids are integers (others are refused); null and empty texts have fingerprint zero and link like any other; a text with fewer words than a
shingle is one shingle; a null id counts as the largest; repeated rows share fingerprint and group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.common import integer_ids, materialize, narrow, slices, small_batches

SEED, SHINGLE, DISTANCE = 42, 3, 3
#: Lowest bit and width of each of the six blocks.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
#: Fingerprints of one key that are compared in one unit of work.
CHUNK = 16_384

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fold(hashes: list[int] | np.ndarray) -> np.uint64:
    """The fingerprint of hashes: a bit is set if over half of them set it."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8192):
        part = np.array(hashes[start : start + 8192], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]


def fingerprint_bits(texts: list[bytes]) -> np.ndarray:
    """Unsigned 64-bit fingerprints."""
    digest, out = xxhash.xxh64_intdigest, np.zeros(len(texts), np.uint64)
    for row, text in enumerate(texts):
        found = text.translate(_LOWER).split()
        if not found:
            continue
        if len(found) <= SHINGLE:
            hashes = [digest(b" ".join(found), SEED)]
        else:
            hashes = [digest(b"%b %b %b" % x, SEED) for x in zip(found, found[1:], found[2:], strict=False)]
        out[row] = fold(hashes)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp bigint, text_hash bigint) for every row; fp holds the unsigned bits, text_hash tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
                whole_hash = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in texts), np.uint64, len(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprint_bits(texts).view(np.int64)), pa.array(whole_hash.view(np.int64))], names=[id_col, "fp", "text_hash"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, fp bigint, text_hash bigint")


def block_keys(fp: Column) -> Column:
    """The twenty three-block keys, each with the number of its choice of blocks."""
    keys = []
    for number, chosen in enumerate(combinations(BLOCKS, 3)):
        mask = sum(((1 << width) - 1) << low for low, width in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def spanning_links(bits: np.ndarray, ids: np.ndarray, direct: bool = False) -> list[tuple[int, int]]:
    """Links (larger id, smaller id) that join the fingerprints within DISTANCE of each other: a spanning forest. direct links
    are themselves within DISTANCE, each to the last such id, so that none becomes the centre of all."""
    order = np.argsort(ids, kind="stable")
    bits, ids = bits[order], ids[order]
    label, out = np.arange(len(ids)), []
    for i in range(1, len(ids)):
        near = np.bitwise_count(bits[:i] ^ bits[i]) <= DISTANCE
        met = np.unique(label[:i][near])
        if len(met):
            # Labels are places in order of id, so the smallest label is the smallest id.
            if direct:
                out += [(int(ids[i]), int(ids[np.flatnonzero(near & (label[:i] == x))[-1]])) for x in met]
            else:
                out += [(int(ids[x]), int(ids[met[0]])) for x in (i, *met[1:])]
            label[i] = met[0]
            for other in met[1:]:
                label[: i + 1][label[: i + 1] == other] = met[0]
    return out


def links(nodes: DataFrame, chunk: int = CHUNK, direct: bool = False) -> DataFrame:
    """(u, v) with u > v: links that connect every two nodes (rep, fp) within DISTANCE, through others or directly."""
    keyed = nodes.select("rep", "fp", F.explode(block_keys(F.col("fp"))).alias("key")).select("rep", "fp", "key.choice", "key.bits")
    hot = keyed.groupBy("choice", "bits").count().where(F.col("count") > chunk)
    hot = hot.select("choice", "bits", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    units = (
        keyed.join(hot, ["choice", "bits"], "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("choice", "bits", F.least("own", "other").alias("c"), F.greatest("own", "other").alias("d"), "rep", "fp")
    )
    keys = ["choice", "bits", "c", "d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(groups: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch | None:
            found = [x for bits, ids in groups for x in spanning_links(bits, ids, direct)]
            if found:
                u, v = zip(*found, strict=True)
                return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
            return None

        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([np.asarray(batch.column(k)).astype(np.int64) for k in range(6)], axis=1)
            rows = np.concatenate([*held, rows]) if held else rows
            cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            starts = np.concatenate([[0], cuts])
            sizes = np.diff(np.concatenate([starts, [len(rows)]]))
            groups = [(rows[s : s + n, 5].view(np.uint64), rows[s : s + n, 4]) for s, n in zip(starts[:-1], sizes[:-1], strict=True) if n > 1]
            held = [rows[starts[-1] :]]
            if (out := emit(groups)) is not None:
                yield out
        if held and len(held[0]) > 1 and (out := emit([(held[0][:, 5].copy().view(np.uint64), held[0][:, 4])])) is not None:
            yield out

    # A unit's rows stand together after the sort; singletons cost nothing but their row.
    return units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u bigint, v bigint").distinct()


def is_settled(edges: DataFrame) -> bool:
    """Whether the links (u, v) are stars: each u has one link, and no v is the u of another."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty()


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge but the smallest ones themselves.

    edges is read several times in a round: a written table. Large-star and small-star steps in turn: neighbours move to
    the smallest one seen until the links are stars. Every step is an aggregation by key, combined before its shuffle, and
    a join; each round is written, so lineage stays short.
    """
    rows = edges.count()  # a round never adds links
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialize(narrow(small.select("e.u", "e.v").where("u <> v").distinct(), 2 * rows), "links")
        if is_settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"links still changed after {max_rounds} rounds")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id_col, fp, text_hash, component_id) for every row: the smallest id among the documents reachable by links."""
    integer_ids(docs, id_col)
    small_batches(docs.sparkSession)
    marked = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    last = F.coalesce(F.col(id_col), F.lit(2**63 - 1))
    nodes = materialize(marked.groupBy("fp").agg(F.min(last).alias("rep")), "nodes")
    joined = connected(materialize(links(nodes, chunk), "links"))
    named = nodes.join(joined, nodes.rep == joined.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return marked.join(named, "fp").select(id_col, "fp", "text_hash", F.when(F.col("component_id") < 2**63 - 1, F.col("component_id")).alias("component_id"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", find: Callable[[DataFrame, str, str], DataFrame] = groups) -> DataFrame:
    """One document of each group that find makes: the row with the smallest id (then text hash), once if that row repeats.

    The choice needs no text; the texts are shuffled once, to meet it, and the repeats fall within that same layout.
    """
    found = find(docs, id_col, text_col)
    chosen = found.groupBy("component_id").agg(F.min(F.struct(F.coalesce(F.col(id_col), F.lit(2**63 - 1)).alias("_id"), F.col("text_hash").alias("_hash"))).alias("_first")).select("_first.*")
    rows = docs.withColumns({"_id": F.coalesce(F.col(id_col), F.lit(2**63 - 1)), "_hash": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    once = Window.partitionBy("_id", "_hash").orderBy("_id", "_hash")
    kept = rows.join(chosen, ["_id", "_hash"], "left_semi").withColumn("_nth", F.row_number().over(once))
    return kept.where("_nth = 1").select(*docs.columns)
