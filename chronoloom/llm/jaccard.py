"""Near-duplicates by similarity: SimHash, then MinHash bands find candidates, exact Jaccard of five-word shingles verifies them.

SimHash fingerprints of the sets that differ in at most three bits (simhash.links) are the first candidates; at a similarity of
0.8 most pairs differ in more, so bands go on from the groups that the verified ones make.

Words are lower-cased as in simhash; a text's set holds the XXH64 hashes of its shingles. Equal sets are one node. A node
has ROWS * BANDS minima; nodes that agree on a band of ROWS minima meet under its key (at a similarity of 0.8 all bands
miss a pair with probability (1 - 0.8 ** 4) ** 20 < 3e-5). A node's sketch has BINS bytes: shingles are dealt to bins by
their hash, and the least of each bin leaves a byte; two sketches agree on a bin of theirs with a probability of the
similarity. Pairs that meet and agree on as many bins as 0.8 would, less SPREAD standard deviations (a pair of 0.8 falls
short with probability below 1e-3), are verified on the sets themselves, made once from the texts of nodes
that meet others. A large group is not verified pair by pair: each node goes through its candidates from the most alike
on, a few in the first round and GROWTH times as many in the next, and skips those already joined to it; rounds end when
every candidate pair is verified or joined through others. Keys with more than CHUNK nodes are cut into pairs of chunks.

Defined results: texts without words are one group; a text with fewer words than a shingle is one shingle; null ids
count as the largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import integer_ids, materialize, narrow, slices, small_batches
from chronoloom.llm.simhash import _LOWER, SEED, connected, fold, links

SHINGLE, ROWS, BANDS = 5, 4, 20
#: Bytes of a sketch, and how many standard deviations below LEAST it may fall.
BINS, SPREAD = 256, 3.3
#: Similarity of near copies, as a fraction.
LEAST = (4, 5)
#: Nodes of one key that are compared in one unit of work.
CHUNK = 4096
#: Candidates of a node that the first round verifies, and the growth from round to round.
FIRST, GROWTH = 4, 64

_DRAW = np.random.default_rng(SEED)
_XOR, _ODD = _DRAW.integers(0, 2**64, (2, ROWS * BANDS, 1), dtype=np.uint64)
_ODD |= np.uint64(1)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    digest, found = xxhash.xxh64_intdigest, text.translate(_LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) <= SHINGLE:
        return np.array([digest(b" ".join(found), SEED)], np.uint64)
    runs = zip(*[found[k:] for k in range(SHINGLE)], strict=False)
    return np.unique(np.fromiter((digest(b"%b %b %b %b %b" % x, SEED) for x in runs), np.uint64, len(found) - SHINGLE + 1))


def minima(hashes: np.ndarray) -> np.ndarray:
    """ROWS * BANDS minima of 32 bits."""
    least = np.full((ROWS * BANDS, 1), 2**64 - 1, np.uint64)
    for start in range(0, len(hashes), 8192):
        seen = (hashes[None, start : start + 8192] ^ _XOR) * _ODD
        least = np.minimum(least, seen.min(axis=1, keepdims=True))
    return (least[:, 0] >> np.uint64(32)).astype("<u4")


def bins(hashes: np.ndarray) -> np.ndarray:
    """A byte of the least hash in each of BINS equal ranges of hashes, 1 to 255; zero for an empty one. hashes are sorted."""
    out = np.zeros(BINS, np.uint8)
    at, first = np.unique(hashes // np.uint64(2**64 // BINS), return_index=True)
    out[at.astype(np.int64)] = 1 + hashes[first] % np.uint64(255)
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, text_hash, node, n, fp, sketch, marks, keys) for every row; texts without words have no keys; marks are 32 bits of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
                rows = []
                for text in texts:
                    hashes = shingle_set(text)
                    least = minima(hashes)
                    keys = [xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in least.reshape(BANDS, ROWS)] if len(hashes) else []
                    node = xxhash.xxh64_intdigest(hashes.tobytes(), SEED)
                    keys = np.array(keys, np.uint64)
                    rows.append((xxhash.xxh64_intdigest(text, SEED), node, len(hashes), fold(hashes) if len(hashes) else 0, bins(hashes).tobytes(), keys.astype("<u4").tobytes(), keys.view(np.int64)))
                whole_hash, node, n, fp, sketch, marks, keys = zip(*rows, strict=True)
                signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                columns = [batch.column(0), signed(whole_hash), signed(node), pa.array(n, pa.int64()), signed(fp), pa.array(sketch, pa.binary()), pa.array(marks, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "text_hash", "node", "n", "fp", "sketch", "marks", "keys"])

    last = F.coalesce(F.col(id_col), F.lit(2**63 - 1)).cast("bigint")
    return docs.select(last.alias("_id"), text_col).mapInArrow(run, "_id bigint, text_hash bigint, node bigint, n bigint, fp bigint, sketch binary, marks binary, keys array<bigint>")


def meetings(nodes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(band, key, c, d, node): nodes that share a band with others, by unit of work."""
    keyed = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    shared = keyed.groupBy("band", "key").count().where("count > 1")
    shared = shared.select("band", "key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    units = keyed.join(shared, ["band", "key"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return units.select("band", "key", F.least("own", "other").alias("c"), F.greatest("own", "other").alias("d"), "node")


def candidates(unit: tuple[np.ndarray, ...], band: int, low: int, high: int) -> tuple[list[tuple[int, int]], bool]:
    """Pairs of a unit, of those that meet in no earlier band, that a round verifies, and whether pairs are left for later ones."""
    order = np.argsort(unit[0], kind="stable")
    node, n, label, sketch, marks = (x[order] for x in unit)
    out, more, share = [], False, LEAST[0] / LEAST[1]
    for i in range(1, len(node)):
        first = (marks[:i] == marks[i]).argmax(axis=1) == band
        seen = ((sketch[:i] | sketch[i]) != 0).sum(axis=1)
        agree = ((sketch[:i] == sketch[i]) & (sketch[i] != 0)).sum(axis=1) / seen
        sizes = LEAST[1] * np.minimum(n[:i], n[i]) >= LEAST[0] * np.maximum(n[:i], n[i])
        # Bins draw without replacement from a union of at most (n + n) / (1 + share) shingles.
        rest = np.maximum(0, 1 - seen * (1 + share) / (n[:i] + n[i]))
        found = np.flatnonzero((agree >= share - SPREAD * np.sqrt(share * (1 - share) * rest / seen) - 1e-9) & sizes & first)
        if len(found):
            # The nearest of equals, so that no node becomes the centre of all.
            found = found[np.lexsort((-found, -agree[found]))]
            apart = label[found] != label[i]
            out += [(int(node[i]), int(node[j])) for j in found[low:high][apart[low:high]]]
            more = more or bool(apart[high:].any())
    return out, more


def proposed(units: DataFrame, low: int, high: int) -> DataFrame:
    """(u, v, more) of one round; a row without u and v tells that later rounds have pairs."""
    keys = ["band", "key", "c", "d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(parts: list[tuple[int, tuple[np.ndarray, ...]]]) -> pa.RecordBatch:
            found = [candidates(x, band, low, high) for band, x in parts]
            pairs = [p for out, _ in found for p in out] + ([(None, None)] if any(m for _, m in found) else [])
            u, v = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        def unit(rows: np.ndarray, sketch: np.ndarray, marks: np.ndarray, s: int, e: int) -> tuple[int, tuple[np.ndarray, ...]]:
            return int(rows[s, 0]), (rows[s:e, 4], rows[s:e, 5], rows[s:e, 6], sketch[s:e], marks[s:e])

        held: tuple[np.ndarray, ...] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([np.asarray(batch.column(k)).astype(np.int64) for k in range(7)], axis=1)
            sketch = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint8).reshape(-1, BINS)
            marks = np.frombuffer(b"".join(batch.column(8).to_pylist()), "<u4").reshape(-1, BANDS)
            if held is not None:
                rows, sketch, marks = (np.concatenate(x) for x in zip(held, (rows, sketch, marks), strict=True))
            cuts = np.concatenate([[0], np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1])
            parts = [unit(rows, sketch, marks, s, e) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e - s > 1]
            held = (rows[cuts[-1] :].copy(), sketch[cuts[-1] :].copy(), marks[cuts[-1] :].copy())
            if parts:
                yield emit(parts)
        if held is not None and len(held[0]) > 1:
            yield emit([unit(*held, 0, len(held[0]))])

    rows = units.select(*keys, "node", "n", "label", "sketch", "marks")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u bigint, v bigint").distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets have a similarity of LEAST or more."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                keep = []
                for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(LEAST[1] * common >= LEAST[0] * (len(a) + len(b) - common))
                yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return both.select("u", "v", "a", "b").mapInArrow(run, "u bigint, v bigint")


def candidate_sets(docs: DataFrame, nodes: DataFrame, met: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, hashes) of the nodes in met, from the text of one document each."""
    wanted = met.select("node").distinct().join(nodes.select("node", "_id", "_hash"), "node")
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(2**63 - 1)).cast("bigint").alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_hash"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                hashes = [shingle_set(x or b"").tobytes() for x in batch.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], names=["node", "hashes"])

    found = rows.join(wanted, ["_id", "_hash"]).select("node", "_text")
    return found.mapInArrow(run, "node bigint, hashes binary").groupBy("node").agg(F.min("hashes").alias("hashes"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, first: int = FIRST) -> DataFrame:
    """(id_col, text_hash, component_id) for every row; component_id numbers the group, and is no document's id."""
    integer_ids(docs, id_col)
    small_batches(docs.sparkSession)
    marked = materialize(sketches(docs, id_col, text_col), "sketches")
    # Equal sets have equal sketches: those of the first row stand for the node.
    first_row = F.min(F.struct("_id", F.col("text_hash").alias("_hash"), "n", "fp", "sketch", "marks", "keys")).alias("first_row")
    nodes = materialize(marked.groupBy("node").agg(first_row).select("node", "first_row.*"), "nodes")
    size = nodes.count()
    close = materialize(narrow(links(nodes.select(F.col("node").alias("rep"), "fp"), direct=True), size * BANDS), "links")
    units = materialize(narrow(meetings(nodes, chunk), size * BANDS), "meetings")
    met = units.select("node").unionByName(close.select(F.explode(F.array("u", "v")).alias("node")))
    sets = materialize(candidate_sets(docs, nodes, met, id_col, text_col), "candidate-sets")
    joined = connected(materialize(narrow(verified(close, sets), size * BANDS), "verified"))
    low, high = 0, first
    while True:
        named = units.join(nodes.select("node", "n", "sketch", "marks"), "node").join(joined, "node", "left").withColumn("label", F.coalesce("component", "node"))
        round_ = materialize(proposed(named, low, high), "proposed")
        new = materialize(narrow(verified(round_.where("u is not null"), sets), round_.count()), "verified")
        if not new.isEmpty():
            joined = connected(new.unionByName(joined.select(F.col("node").alias("u"), F.col("component").alias("v"))))
        if round_.where("u is null").isEmpty():
            break
        low, high = high, high * GROWTH
    label = F.coalesce("component", "node").alias("component_id")
    return marked.join(joined, "node", "left").select(F.col("_id").alias(id_col), "text_hash", label)
