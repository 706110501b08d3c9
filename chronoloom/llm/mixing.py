"""Mixing sources to target weights.

Sources share a part of all words by weight; a source stops at a multiple of its size and what is over is shared again.
Each source is cut into at most MAX_BLOCKS blocks by a seeded hash and each epoch permutes its blocks; whole blocks are
drawn until the quota is met, and the block that straddles it gives documents in hash order, the last one in part. The
drawn blocks, counted by source, are then dealt to output shards by a splitting tree: every node halves its quotas by a
multivariate hypergeometric draw (inverse distribution function over seeded uniforms), so every shard holds a random
mixture with exact totals. Sources stand in groups of GROUP; a node's draw is first split over the groups by a tree of
its own, then within each group, so no row and no task holds all sources. A shard takes the next blocks of each source's
permutation and shuffles its documents locally, by hash.

Only built-in functions. Windows run over one source's bounded blocks or shards, within straddling blocks, or within a
shard. The draw follows the seed alone, so reruns agree.

Defined results: null texts have size 0; null sources are one source that sorts last; documents of size 0 are taken
with 0 words; repeated rows are separate documents. Input columns keep their names and values, except those named like
a result column, which are replaced.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.common import let, materialize

WEIGHTS = (5, 2, 1)
#: A block has about BLOCK_WORDS words; a source has at most MAX_BLOCKS blocks, which bounds every window over one source.
BLOCK_WORDS, MAX_BLOCKS = 16_384, 1 << 20
BLOCKS_PER_SHARD = 64
#: Sources whose quotas stand in one row of the splitting tree.
GROUP = 64
#: A join side of at most so many rows (of about 60 bytes) is broadcast; a larger one is shuffled, a source's documents over SALTS tasks.
BROADCAST_ROWS, SALTS = 200_000, 64
#: The columns that mix() adds.
MADE = ["source_size", "target", "taken_0", "taken_1", "shard_0", "shard_1", "mix_key"]


def uniform(*parts: Column | int | str) -> Column:
    """A number in [0, 1) that follows its parts alone."""
    columns = [x if isinstance(x, Column) else F.lit(x) for x in parts]
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53)


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """sizes with rank: the place of each source in code point order, null last, counted through sorted partitions."""
    order = F.col("source").asc_nulls_last()
    placed = materialize(sizes.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).count()  # one row a partition
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(counts.select("_part", before.alias("_before")))
    ranked = placed.withColumn("_part", part).join(starts, "_part")
    return ranked.select((F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank"), "source", "source_size")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(rank, source, source_size, target) from (source, source_size): min(most * size, weight * level) with one level for all."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked_sources(sizes).withColumns({"weight": weight, "cap": most * F.col("source_size")}), "mix-ranks")
    level, stopped = 0.0, -1
    while True:
        # Sources stop in rounds: each raises the level for the others, so the set only grows.
        over = F.col("cap") < F.col("weight") * F.lit(level)
        row = ranked.agg(F.count_if(over).alias("n"), F.sum("source_size").alias("all"), F.sum(F.when(over, F.col("cap"))).alias("gone"), F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if row["n"] == stopped or not row["open"]:
            break
        stopped, level = row["n"], (share * row["all"] - (row["gone"] or 0.0)) / row["open"]
    return ranked.select("rank", "source", "source_size", F.least(F.col("cap"), F.col("weight") * F.lit(level)).alias("target"))


def hypergeometric(population: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of `drawn` items are marked: the inverse distribution function at u, going out from the mode.

    Values more than 12 standard deviations and 12 steps from the mode have less than double precision's share.
    """

    def found(m: Column) -> Column:
        lo, hi = F.greatest(F.lit(0), drawn - population + marked), F.least(drawn, marked)
        p = marked / population
        reach = F.ceil(12 * F.sqrt(F.greatest(drawn * p * (1 - p), F.lit(0.0))) + 12)
        ups, downs = F.sequence(m, F.greatest(m, F.least(hi, m + reach) - 1)), F.sequence(m, F.least(m, F.greatest(lo, m - reach) + 1))

        def up(k: Column) -> Column:
            return F.greatest((marked - k) * (drawn - k) / ((k + 1) * (population - marked - drawn + k + 1)), F.lit(0.0))

        def down(k: Column) -> Column:
            below = (marked - k + 1) * (drawn - k + 1)
            return F.greatest(F.try_divide(k * (population - marked - drawn + k), below), F.lit(0.0))

        def total(steps: Column, ratio) -> Column:
            start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
            return F.aggregate(steps, start, lambda a, k: let(a["w"] * ratio(k), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))), lambda a: a["sum"])

        def place(steps: Column, ratio, step: int, rest: Column) -> Column:
            start = F.struct(F.lit(1.0).alias("w"), rest.alias("rest"), F.lit(None).cast("bigint").alias("k"))

            def walk(a: Column, k: Column) -> Column:
                return let(a["w"] * ratio(k), lambda w: F.struct(w.alias("w"), (a["rest"] - w).alias("rest"), F.coalesce(a["k"], F.when(a["rest"] < w, k + step)).alias("k")))

            return F.aggregate(steps, start, walk, lambda a: a["k"])

        def pick(above: Column) -> Column:
            def below_sum(under: Column) -> Column:
                rest = u * (1 + above + under) - 1
                return F.when(rest < 0, m).when(rest < above, place(ups, up, 1, rest)).otherwise(place(downs, down, -1, rest - above))

            return let(total(downs, down), below_sum)

        return F.when(lo >= hi, lo).otherwise(F.greatest(lo, F.least(hi, F.coalesce(let(total(ups, up), pick), m))))

    mode = F.floor((drawn + 1) * (marked + 1) / (population + 2)).cast("bigint")
    bounded = F.greatest(F.least(mode, drawn, marked), drawn - population + marked, F.lit(0)).cast("bigint")
    return F.when(population < 1, F.lit(0).cast("bigint")).otherwise(let(bounded, found))


def group_draws(sums: DataFrame, groups: int, level: int, seed: int) -> DataFrame:
    """(shard, part, drawn) from (shard, part, whole): half of each shard's items, split over its groups of sources."""
    half = F.floor((F.col("whole") + 1) / 2).cast("bigint")
    if groups == 1:
        return sums.select("shard", "part", half.alias("drawn"))
    tiers = [sums]
    while groups > 1:
        groups = (groups + 1) // 2
        tiers.append(tiers[-1].groupBy("shard", F.shiftright("part", 1).alias("part")).agg(F.sum("whole").alias("whole")))
    drawn = tiers[-1].select("shard", "part", half.alias("drawn"))
    for depth, tier in reversed(list(enumerate(tiers[:-1]))):
        side = lambda bit: F.coalesce(F.max(F.when(F.col("part").bitwiseAND(F.lit(1)) == bit, F.col("whole"))), F.lit(0))
        pairs = tier.groupBy("shard", F.shiftright("part", 1).alias("up")).agg(side(0).alias("w0"), side(1).alias("w1"))
        pairs = pairs.join(drawn.withColumnRenamed("part", "up"), ["shard", "up"])
        left = hypergeometric(F.col("w0") + F.col("w1"), F.col("w0"), F.col("drawn"), uniform(seed, level, depth, F.col("shard"), F.col("up")))
        both = F.array(F.struct((2 * F.col("up")).alias("part"), F.col("left").alias("drawn")), F.struct((2 * F.col("up") + 1).alias("part"), (F.col("drawn") - F.col("left")).alias("drawn")))
        drawn = pairs.withColumn("left", left).select("shard", F.explode(both).alias("x")).select("shard", "x.part", "x.drawn")
    return drawn


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, rank, n) from (rank, n): each level halves every node by one multivariate draw; ranks without items drop out."""
    rows = quotas.where("n > 0").groupBy(F.floor(F.col("rank") / GROUP).cast("bigint").alias("part")).agg(F.sort_array(F.collect_list(F.struct("rank", F.col("n").cast("bigint").alias("n")))).alias("quotas"))
    nodes = rows.select(F.lit(0).cast("bigint").alias("shard"), "part", "quotas")
    groups = ((quotas.agg(F.max("rank")).first()[0] or 0) // GROUP) + 1
    whole = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda a, q: a + q["n"])
    for level in range(levels):
        sums = nodes.withColumn("whole", whole)
        if groups > 1:
            sums = materialize(sums, "mix-nodes")
            drawn = sums.join(group_draws(sums.select("shard", "part", "whole"), groups, level, seed), ["shard", "part"])
        else:
            drawn = sums.withColumn("drawn", F.floor((F.col("whole") + 1) / 2).cast("bigint"))
        u = partial(uniform, seed, level, F.col("shard"))

        def draw(a: Column, q: Column) -> Column:
            x = hypergeometric(a["population"], q["n"], a["drawn"], u(q["rank"]))  # noqa: B023
            return let(x, lambda k: F.struct((a["population"] - q["n"]).alias("population"), (a["drawn"] - k).alias("drawn"), F.array_append(a["left"], k).alias("left")))

        # At most GROUP entries, so appending to the list of draws stays cheap.
        start = F.struct(F.col("whole").alias("population"), F.col("drawn"), F.array().cast("array<bigint>").alias("left"))
        drawn = drawn.withColumn("left", F.aggregate("quotas", start, draw, lambda a: a["left"]))
        side = lambda value: F.filter(F.zip_with("quotas", "left", lambda q, k: F.struct(q["rank"].alias("rank"), value(q, k).alias("n"))), lambda q: q["n"] > 0)
        halves = F.array(
            F.struct((2 * F.col("shard")).alias("shard"), side(lambda q, k: k).alias("quotas")),
            F.struct((2 * F.col("shard") + 1).alias("shard"), side(lambda q, k: q["n"] - k).alias("quotas")),
        )
        nodes = drawn.select("part", F.explode(halves).alias("half")).select("half.shard", "part", "half.quotas").where(F.size("quotas") > 0)
    return nodes.select("shard", F.explode("quotas").alias("q")).select("shard", "q.rank", "q.n")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 7) -> DataFrame:
    """docs with source_size, target, taken_0, taken_1 (words of each epoch), shard_0, shard_1 and mix_key (the order within a shard).

    size_col holds each document's words.
    """
    columns = [c for c in docs.columns if c not in MADE]
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size"))
    targets = materialize(source_targets(sizes, share, most, weights), "mix-targets")
    cut = F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("source_size") / BLOCK_WORDS))).cast("int")
    known = targets.select(F.col("source").alias("of"), "rank", "source_size", "target", cut.alias("n_blocks"))
    # The input row stays in one column, so none of its names can meet one of ours.
    row = docs.select(F.struct(*columns).alias("row"), F.col(source_col).alias("source"), F.col(size_col).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(size_col)).alias("mix_key"))
    if targets.count() <= BROADCAST_ROWS:
        keyed = row.join(F.broadcast(known), row["source"].eqNullSafe(known["of"]))
    else:
        salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        row = row.withColumn("_salt", F.pmod(F.xxhash64("mix_key"), F.lit(SALTS)).cast("int"))
        keyed = row.join(salted, row["source"].eqNullSafe(salted["of"]) & (row["_salt"] == salted["salt"]))
    keyed = keyed.select("row", "size", "mix_key", "rank", "source_size", "target", F.pmod(F.xxhash64(F.lit("block"), "mix_key"), "n_blocks").cast("int").alias("block"))

    blocks = keyed.groupBy("rank", "block").agg(F.sum("size").alias("words"), F.max("source_size").alias("source_size"), F.max("target").alias("target"))
    blocks = materialize(blocks, "mix-blocks").withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(1))))
    order = Window.partitionBy("rank", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "rank", "block"), "block")
    quota = F.greatest(F.lit(0), F.floor("target") - F.col("epoch") * F.col("source_size"))
    drawn = blocks.withColumn("before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    drawn = drawn.withColumn("take", F.greatest(F.lit(0), F.least(F.col("words"), quota - F.col("before"))))
    drawn = materialize(drawn.select("rank", "block", "epoch", "words", "take"), "mix-drawn")

    used = drawn.where("take > 0")
    turn = Window.partitionBy("rank").orderBy("epoch", F.xxhash64(F.lit(seed), "epoch", "rank", "block"), "block")
    used = used.withColumn("turn", F.row_number().over(turn) - 1)
    quotas = materialize(used.groupBy("rank").agg(F.count("*").alias("n")), "mix-quotas")
    n_blocks = quotas.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    levels = 0
    while n_blocks > BLOCKS_PER_SHARD << levels:
        levels += 1
    shards = split_quotas(quotas, levels, seed)
    first = F.sum("n").over(Window.partitionBy("rank").orderBy("shard")) - F.col("n")
    turns = shards.withColumn("first", first).select("rank", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("turn"))
    dealt = used.join(turns, ["rank", "turn"]).select("rank", "block", "epoch", "shard")
    by_block = drawn.join(dealt, ["rank", "block", "epoch"], "left").groupBy("rank", "block")
    pick = lambda column, epoch: F.max(F.when(F.col("epoch") == epoch, F.col(column)))
    plan = by_block.agg(
        pick("take", 0).alias("take_0"), pick("take", 1).alias("take_1"), pick("shard", 0).alias("shard_0"), pick("shard", 1).alias("shard_1"),
        F.max((F.col("take") > 0) & (F.col("take") < F.col("words"))).alias("partly"),
    )
    plan = materialize(plan, "mix-plan")
    if plan.count() <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    joined = keyed.join(plan, ["rank", "block"])
    whole = joined.where("not partly").withColumns({f"taken_{e}": F.when(F.col(f"take_{e}") > 0, F.col("size")).otherwise(0) for e in (0, 1)})
    # Rows of one id and size are told apart by their other values.
    plain = [F.col("row").getField(f.name) for f in docs.select(*columns).schema if not re.search("map<|variant", f.dataType.simpleString())]
    inside = Window.partitionBy("rank", "block").orderBy("mix_key", F.xxhash64(*plain)).rowsBetween(Window.unboundedPreceding, -1)
    parted = joined.where("partly").withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    parted = parted.withColumns({f"taken_{e}": F.greatest(F.lit(0), F.least(F.col("size"), F.col(f"take_{e}") - F.col("before"))) for e in (0, 1)}).drop("before")
    out = whole.unionByName(parted)
    # A document that an epoch leaves out has no shard in it.
    out = out.withColumns({f"shard_{e}": F.when(F.col(f"taken_{e}") > 0, F.col(f"shard_{e}")) for e in (0, 1)})
    return out.select(*[F.col("row").getField(c).alias(c) for c in columns], *MADE)


def in_shards(mixed: DataFrame, columns: list[str], seed: int = 7) -> DataFrame:
    """(columns, taken, shard): a row for each time that a document is taken, shard by shard, shuffled within its shard."""
    times = F.array(*[F.struct(F.col(f"taken_{e}").alias("taken"), F.col(f"shard_{e}").alias("shard"), F.xxhash64(F.lit(seed), F.lit(e), "mix_key").alias("key")) for e in (0, 1)])
    rows = mixed.select(F.struct(*columns).alias("row"), F.explode(F.filter(times, lambda x: x["taken"] > 0)).alias("x"))
    rows = rows.repartition("x.shard").sortWithinPartitions("x.shard", "x.key")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns], "x.taken", "x.shard")


def with_places(mixed: DataFrame, seed: int = 7) -> DataFrame:
    """mixed with place_0 and place_1: where the local shuffle of its shard puts a document in each epoch, counted from 1."""
    for e in (0, 1):
        # Documents that an epoch leaves out stay apart, spread by their hash.
        apart = F.when(F.col(f"shard_{e}").isNull(), F.pmod(F.xxhash64("mix_key"), F.lit(1 << 20)))
        shuffled = Window.partitionBy(f"shard_{e}", apart).orderBy(F.xxhash64(F.lit(seed), F.lit(e), "mix_key"), "mix_key")
        mixed = mixed.withColumn(f"place_{e}", F.when(F.col(f"shard_{e}").isNotNull(), F.row_number().over(shuffled)))
    return mixed
