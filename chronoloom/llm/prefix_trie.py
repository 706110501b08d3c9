"""The prefix trie of conversations: every distinct beginning once, with what its subtree holds.

A turn's place in its conversation, and the identity of each prefix (128 bits, the exclusive or of hashes of depth and turn),
are running aggregates over a layout sorted by conversation. That layout is dealt out by range, so that a long conversation
may lie in several ranges; the few that do (one for each border between ranges at most) get what lies before from a small table.

Nodes where a conversation ends or the paths part are stored; the chains between them have the same members throughout. One
path for each distinct conversation is dealt out by range of its beginnings. A task cuts its paths into shards of bounded
size and encodes each as balanced parentheses, one pair for a stored node, with the least and greatest excess of each block
and of growing ranges of blocks. findclose delimits a node's subtree; the difference of the ranks of leaf pairs at both
ends counts leaves; a cumulative array over the sequence gives savings. A node whose paths lie in several shards (their shared
spine) is merged by adding; what a node itself saves is counted only in the shard that holds its smallest member.

Defined results: rows without a conversation id belong to none and are left out; null roles and texts are empty; turns are in
order of turn (null first), then role, then text, and repeated rows are turns of their own; a table without conversations has
no nodes, not even a root; whole texts of any length count; columns other than the four named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.common import integer_ids, materialize

#: Parentheses in a block, rows of paths in a shard, depths in a bucket of the join with chains.
BLOCK, SHARD_ROWS, SPAN = 64, 1 << 17, 256
NODE = ["depth", "ka", "kb"]
#: Depths whose prefixes order the paths.
_MARKS = (1, 2, 4, 8)


def part(at: Column) -> Column:
    """The partition in which a row got its increasing id."""
    return F.shiftright(at, 33)


def placed(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, part, depth, t, size, n, first_part), one row a turn: t tells turns apart, size is the text's bytes, n the conversation's turns."""
    integer_ids(conversations, conv_col)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.concat(role, F.lit("\0"), text).alias("said"), text.alias("text"))
    # The ranges' borders are drawn from a short beginning of the text, which is in the same order.
    ranged = rows.repartitionByRange("conv", "turn", F.substring("said", 1, 64)).sortWithinPartitions("conv", "turn", "said", "role")
    same = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    laid = materialize(ranged.select("conv", F.monotonically_increasing_id().alias("at"), F.unhex(F.substring(same, 1, 32)).alias("t"), F.octet_length("text").cast("bigint").alias("size")), "turns")
    laid = laid.withColumn("part", part(F.col("at")))
    own = Window.partitionBy("conv")
    pieces = laid.groupBy("conv", "part").count()
    pieces = pieces.withColumns({"n": F.sum("count").over(own), "first_part": F.min("part").over(own), "before": F.sum("count").over(own.orderBy("part")) - F.col("count")})
    crossing = F.broadcast(pieces.where("n > count").select("conv", "part", "n", "first_part", "before"))
    here = Window.partitionBy("conv", "part")
    rows = laid.withColumns({"_place": F.row_number().over(here.orderBy("at")), "_here": F.count("*").over(here)}).join(crossing, ["conv", "part"], "left")
    return materialize(rows.select("conv", "part", (F.col("_place") + F.coalesce("before", F.lit(0))).cast("bigint").alias("depth"), "t", "size", F.coalesce("n", "_here").alias("n"), F.coalesce("first_part", "part").alias("first_part")), "placed")


def with_shared_heads(rows: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations) in which each conversation c begins with the first h turns of c - c % every, h = crc32(c) % most, in
    place of its own first h; % keeps the sign of c. rows are those of placed; conversations are (conv, n)."""
    convs = rows.where("depth = 1").select("conv", F.col("first_part").alias("part"), "n")
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    plan = convs.withColumns({"h": h, "base": F.col("conv") - F.col("conv") % every})
    plan = plan.join(convs.select(F.col("conv").alias("base"), F.col("n").alias("_there")), "base", "left").withColumn("head", F.least("h", F.coalesce("_there", F.lit(0))))
    plan = materialize(plan.select("conv", "part", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")), "heads")
    heads = rows.where((F.col("depth") < most) & (F.col("conv") % every == 0)).select(F.col("conv").alias("base"), "depth", "t", "size")
    heads = plan.join(heads, "base").where("depth <= head").select("conv", "part", "depth", "t", "size", "n")
    own = rows.drop("n").join(plan.drop("part"), "conv").where("depth > h")
    own = own.select("conv", "part", (F.col("head") + F.col("depth") - F.col("h")).alias("depth"), "t", "size", "n")
    return heads.unionByName(own), plan.select("conv", "n")


def prefixes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, ka, kb, pa, pb, size, total, ends): each prefix of each conversation, its parent's key, the bytes so far."""
    lane = lambda k: F.xxhash64(F.lit(k), "depth", "t")
    rows = rows.withColumns({"a": lane(1), "b": lane(2)})
    sums = {"a": F.bit_xor("a"), "b": F.bit_xor("b"), "size": F.sum("size")}
    pieces = rows.groupBy("conv", "part").agg(*[v.alias(k) for k, v in sums.items()])
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select("conv", "part", *[v.over(earlier).alias(f"_{k}") for k, v in sums.items()]).where("_a is not null")
    here = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumns({f"{k}_": v.over(here) for k, v in sums.items()}).join(F.broadcast(before), ["conv", "part"], "left")
    none = F.lit(0).cast("bigint")
    ka, kb = (F.col(f"{k}_").bitwiseXOR(F.coalesce(f"_{k}", none)) for k in ("a", "b"))
    total = F.col("size_") + F.coalesce("_size", none)
    turns = run.select("conv", "depth", ka.alias("ka"), kb.alias("kb"), ka.bitwiseXOR(F.col("a")).alias("pa"), kb.bitwiseXOR(F.col("b")).alias("pb"), "size", total.alias("total"), (F.col("depth") == F.col("n")).alias("ends"))
    roots = convs.select("conv", none.alias("depth"), *[none.alias(c) for c in ("ka", "kb", "pa", "pb", "size", "total")], (F.col("n") == 0).alias("ends"))
    return materialize(turns.unionByName(roots), "prefixes")


class Parens:
    """Balanced parentheses in bits, with the least and greatest excess of blocks and of ranges of 2, 4, 8... blocks."""

    def __init__(self, bits: np.ndarray) -> None:
        blocks = -(-len(bits) // BLOCK)
        padded = np.zeros(blocks * BLOCK, np.uint8)
        padded[: len(bits)] = bits
        self.packed = np.packbits(padded.reshape(blocks, BLOCK), axis=1)
        excess = np.cumsum(padded.astype(np.int64) * 2 - 1).reshape(blocks, BLOCK)
        self.begin = np.concatenate([[0], excess[:-1, -1]])
        self.low, self.high = [excess.min(axis=1)], [excess.max(axis=1)]
        while len(self.low[-1]) > 1:
            for levels, least in ((self.low, np.minimum), (self.high, np.maximum)):
                under = levels[-1]
                pairs = np.append(under, under[-1]) if len(under) % 2 else under
                levels.append(least(pairs[0::2], pairs[1::2]))

    def excess(self, block: np.ndarray) -> np.ndarray:
        return np.cumsum(np.unpackbits(self.packed[block], axis=1).astype(np.int64) * 2 - 1, axis=1) + self.begin[block][:, None]

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The place at which each open parenthesis closes."""
        return np.concatenate([self._find_close(opens[k : k + 8192]) for k in range(0, len(opens), 8192)]) if len(opens) else opens

    def _find_close(self, opens: np.ndarray) -> np.ndarray:
        block, within = opens // BLOCK, opens % BLOCK
        own = self.excess(block)
        wanted = own[np.arange(len(opens)), within] - 1
        match = (own == wanted[:, None]) & (np.arange(BLOCK) > within[:, None])
        out = np.where(match.any(axis=1), block * BLOCK + match.argmax(axis=1), -1)
        open_ = np.flatnonzero(out < 0)
        node, goal, level = block[open_].copy(), wanted[open_], np.full(len(open_), -1)
        # Up to the first range on the right whose excess includes the goal, then down to its first such block.
        for k in range(len(self.low)):
            up = level < 0
            beside = np.minimum(node + 1, len(self.low[k]) - 1)
            hit = up & (node % 2 == 0) & (beside > node) & (self.low[k][beside] <= goal) & (self.high[k][beside] >= goal)
            node, level = np.where(hit, beside, np.where(up, node // 2, node)), np.where(hit, k, level)
        for k in range(len(self.low) - 1, 0, -1):
            at = level >= k
            first = np.minimum(node * 2, len(self.low[k - 1]) - 1)
            inside = (self.low[k - 1][first] <= goal) & (self.high[k - 1][first] >= goal)
            node = np.where(at, np.where(inside, first, first + 1), node)
        if len(open_):
            out[open_] = node * BLOCK + (self.excess(node) == goal[:, None]).argmax(axis=1)
        return out


_PATH = [*NODE, "total", "conv", "n_convs", "owner", "childless"]
_VALUES = "depth bigint, ka bigint, kb bigint, leaves bigint, saved bigint, above bigint, above_total bigint"


def encode_shard(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Leaves and savings of each stored node of a shard, within the shard. rows: the stored nodes of whole paths, from the top on."""
    starts = np.flatnonzero(np.concatenate([[True], rows["conv"][1:] != rows["conv"][:-1]]))
    ends = np.append(starts[1:], len(rows["conv"]))
    keys = np.stack([rows[c] for c in NODE], axis=1)
    distinct, first, node = np.unique(keys, axis=0, return_index=True, return_inverse=True)
    above, above_total = (np.concatenate([[0], rows[c][:-1]]) for c in ("depth", "total"))
    above[starts], above_total[starts] = 0, 0
    node = node.reshape(-1)
    own = rows["owner"].astype(bool)
    value, top, top_total = (np.zeros(len(distinct), np.int64) for _ in range(3))
    top -= 1
    value[node[own]] = ((rows["n_convs"] - 1) * (rows["total"] - above_total))[own]
    top[node[own]], top_total[node[own]] = above[own], above_total[own]
    plain, bits, order, before = node.tolist(), [1], [-1], ()
    for path in sorted(tuple(plain[s:e]) for s, e in zip(starts, ends, strict=True)):
        same = 0
        for x, y in zip(before, path, strict=False):
            if x != y:
                break
            same += 1
        bits += [0] * (len(before) - same) + [1] * (len(path) - same)
        order += path[same:]
        before = path
    bits = np.array(bits + [0] * (len(before) + 1), np.uint8)
    opens, order = np.flatnonzero(bits), np.array(order)
    closes = Parens(bits).find_close(opens)
    held = order >= 0
    leaf = np.zeros(len(bits), np.int64)
    # A pair whose children lie in other shards alone is no leaf.
    leaf[opens[held]] = (bits[opens[held] + 1] == 0) & (rows["childless"][first[order[held]]] > 0)
    saved = np.zeros(len(bits), np.int64)
    saved[opens[held]] = value[order[held]]
    within = [np.cumsum(x) for x in (leaf, saved)]
    leaves, saves = (x[closes] - np.where(opens > 0, x[opens - 1], 0) for x in within)
    at = np.where(held, order, 0)
    root = lambda x, r: np.where(held, x[at], r)
    columns = [*[root(distinct[:, k], 0) for k in range(3)], leaves, saves, root(top, -1), root(top_total, 0)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=[x.split()[0] for x in _VALUES.split(", ")])


def shards(batches: Iterator[pa.RecordBatch], most: int = SHARD_ROWS) -> Iterator[pa.RecordBatch]:
    """Cuts sorted paths into shards of about `most` rows; a path stays whole."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        held.append({c: np.asarray(batch.column(k)).astype(np.int64) for k, c in enumerate(_PATH)})
        if sum(len(x["conv"]) for x in held) < most:
            continue
        rows = {c: np.concatenate([x[c] for x in held]) for c in _PATH}
        cut = int(np.flatnonzero(np.concatenate([[True], rows["conv"][1:] != rows["conv"][:-1]]))[-1])
        if cut:
            yield encode_shard({c: x[:cut] for c, x in rows.items()})
        held = [{c: x[cut:] for c, x in rows.items()}]
    if sum(len(x["conv"]) for x in held):
        yield encode_shard({c: np.concatenate([x[c] for x in held]) for c in _PATH})


def member_digests(ends: DataFrame) -> DataFrame:
    """(depth, ka, kb, ends_sha256) of the conversations that end at a node: ids are joined in pieces by range, then the pieces go
    through the hash in order; a node that ends many conversations is a few rows by then."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([np.asarray(batch.column(k)).astype(np.int64) for k in range(4)], axis=1)
            cuts = np.flatnonzero(np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)]))
            texts = [",".join(map(str, rows[s:e, 3].tolist())) for s, e in zip(cuts, np.append(cuts[1:], len(rows)), strict=True)]
            yield pa.RecordBatch.from_arrays([*[pa.array(rows[cuts, k]) for k in range(4)], pa.array(texts, pa.string())], names=[*NODE, "least", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=[*NODE, "ends_sha256"])
        for batch in batches:
            out = []
            for *key, ids in zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 4)], strict=True):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            if out:
                yield made(out)
        if now is not None:
            yield made([(*now, state.hexdigest())])

    ranged = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    pieces = ranged.mapInArrow(join, "depth bigint, ka bigint, kb bigint, least bigint, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "least").mapInArrow(digest, "depth bigint, ka bigint, kb bigint, ends_sha256 string")


def stored_paths(chains: DataFrame, nodes: DataFrame) -> DataFrame:
    """The stored nodes, but the root, on one path for each distinct conversation, ordered by beginnings and from the top on."""
    reps = nodes.where("rep is not null").select(F.col("rep").alias("conv"))
    paths = chains.where("depth > 0").join(reps, "conv", "left_semi").select("conv", *NODE, "total")
    marks = paths.where(F.col("depth").isin(*_MARKS)).groupBy("conv").agg(*[F.max(F.when(F.col("depth") == d, F.col("ka"))).alias(f"o{d}") for d in _MARKS])
    stored = nodes.where("stored and depth > 0").select(*NODE, "n_convs", "conv_id", (F.col("n_children") == 0).alias("childless"))
    rows = paths.join(stored, NODE).withColumn("owner", F.col("conv") == F.col("conv_id")).join(marks, "conv")
    order = [*[f"o{d}" for d in _MARKS], "conv"]
    flags = [F.col(c).cast("bigint").alias(c) for c in ("owner", "childless")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order, "depth").select(*NODE, "total", "conv", "n_convs", *flags)


def trie(rows: DataFrame, convs: DataFrame | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for each node.

    rows are those of placed, or of with_shared_heads with its conversations (conv, n), which also hold those without turns.
    """
    chains = prefixes(rows, rows.where("depth = 1").select("conv", "n") if convs is None else convs)
    nodes = chains.groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), *[F.max(c).alias(c) for c in ("pa", "pb", "size", "total")], F.min(F.when(F.col("ends"), F.col("conv"))).alias("rep"),
    )
    nodes = materialize(nodes, "trie-nodes")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    nodes = materialize(nodes.withColumn("stored", (F.col("depth") == 0) | F.col("rep").isNotNull() | (F.col("n_children") != 1)), "trie-stored")
    values = stored_paths(chains, nodes).mapInArrow(lambda batches: shards(batches, shard_rows), _VALUES)
    merged = values.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in ("leaves", "saved")], *[F.max(c).alias(c) for c in ("above", "above_total")])
    ended = member_digests(chains.where("ends"))
    stored = nodes.where("stored").select(*NODE, "conv_id").join(merged, NODE, "left")
    # The chain above a stored node, up to the stored node before it, has the same members, and so the same smallest one.
    above = F.coalesce("above", F.lit(-1).cast("bigint"))
    spans = stored.withColumn("_b", F.explode(F.sequence(F.floor((above + 1) / SPAN), F.floor(F.col("depth") / SPAN))))
    spans = spans.select("conv_id", "_b", F.col("depth").alias("_to"), above.alias("_from"), F.coalesce("leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved"), F.coalesce("above_total", F.lit(0)).alias("_total"))
    all_ = nodes.withColumn("_b", F.floor(F.col("depth") / SPAN)).join(spans, ["conv_id", "_b"]).where("depth > _from and depth <= _to")
    saved = F.col("saved") - F.greatest(F.col("n_convs") - 1, F.lit(0)) * (F.col("total") - F.col("size") - F.col("_total"))
    all_ = all_.withColumn("saved_tokens", saved).join(ended, NODE, "left")
    parents = nodes.select(F.col("depth").alias("_d"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    out = all_.withColumn("_d", F.col("depth") - 1).join(parents, ["_d", "pa", "pb"], "left")
    none = hashlib.sha256(b"").hexdigest()
    whole = [F.col(c).cast("bigint").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    return out.select(*whole, F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
