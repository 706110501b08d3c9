"""Byte-level BPE encoding and decoding.

The pattern splits each text into words. The most frequent distinct words of the corpus, at most HOT_WORDS of them, are
folded once each by Spark higher-order functions: an `aggregate` over an array of byte pieces merges the adjacent pair of
lowest rank until no pair has a rank, with the ranks in a literal map; a word is held as a string with one character per
byte (Latin-1), so pieces concatenate as strings. Their ids are written as a table of a proven size, which each worker
reads once, and texts are looked up in it. Words beyond the bound are merged in the task by the same rule: folding them
too costs several times the rest of the encoding, and bringing them to their texts would shuffle more than the input.

Defined results: a null text counts as empty; an empty text has no ids; repeated rows give repeated results.
The white-space and letter classes are those of the JVM's Unicode tables.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import let, materialize_at, shared_fs, slices, small_batches

#: At most so many words, of so many bytes each, are folded ahead for all tasks: 524288 * (64 bytes + 64 ids).
HOT_WORDS, HOT_BYTES = 1 << 19, 64
#: Buckets of the literal rank map; a lookup scans one bucket of a few entries.
BUCKETS = 1 << 15
#: Bytes of words that a task holds at once.
SLICE_BYTES = 24 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 bytes and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def jvm_pattern(pattern: str) -> str:
    """The same pattern with white space as Unicode defines it, which the JVM's \\s does not."""
    return pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def pretokens(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(jvm_pattern(pattern)), F.lit(0))


def rank_map(ranks: dict[bytes, int]) -> Column:
    """A literal array of small maps, indexed by the low bits of the key's crc32. The optimizer folds it once."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        key = token.decode("latin-1")
        buckets[zlib.crc32(key.encode()) & (BUCKETS - 1)][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def rank_of(buckets: Column, piece: Column) -> Column:
    """Null where the piece has no rank."""
    at = F.crc32(piece.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    return F.try_element_at(F.get(buckets, at), piece)


def fold_word(word: Column, buckets: Column) -> Column:
    """Ids of one word by ranked merges over its bytes.

    p holds the pieces behind a null, r at each place the rank of the piece there joined with the next one.
    """

    def merge(s: Column, _: Column) -> Column:
        p, r = s["p"], s["r"]

        def join(k: Column) -> Column:
            def around(piece: Column) -> Column:
                ranks = F.array(rank_of(buckets, F.concat(F.get(p, k - 2), piece)), rank_of(buckets, F.concat(piece, F.get(p, k + 1))))
                rest = F.size(p)
                return F.struct(
                    F.concat(F.slice(p, F.lit(1), k - 1), F.array(piece), F.slice(p, k + 2, rest)).alias("p"),
                    F.concat(F.slice(r, F.lit(1), k - 2), ranks, F.slice(r, k + 2, rest)).alias("r"),
                )

            return let(F.concat(F.get(p, k - 1), F.get(p, k)), around)

        return let(F.array_min(r), lambda least: F.when(least.isNull(), s).otherwise(let(F.array_position(r, least).cast("int"), join)))

    def folded(latin: Column) -> Column:
        whole = rank_of(buckets, latin)
        bytes_ = F.concat(F.array(F.lit(None).cast("string")), F.split(latin, "(?s)(?<=.)(?=.)"))
        ranked = let(bytes_, lambda p: F.struct(p.alias("p"), F.transform(p, lambda x, i: rank_of(buckets, F.concat(x, F.get(p, i + 1)))).alias("r")))
        steps = F.sequence(F.lit(1), F.greatest(F.length(latin) - 1, F.lit(1)))
        merged = F.aggregate(steps, ranked, merge, lambda s: F.slice(s["p"], F.lit(2), F.size(s["p"])))
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(merged, lambda piece: rank_of(buckets, piece)))

    return let(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), folded)


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one word of any length: a heap of ranked pairs over linked pieces, n log n."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    ends, left, right, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if j >= n or ends[j] != end:
            continue
        alive[j], ends[i], right[i] = False, end, right[j]
        if right[j] < n:
            left[right[j]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if 0 <= a and b < n and (r := ranks.get(word[a : ends[b]])) is not None:
                heapq.heappush(heap, (r, a, ends[b]))
    return [ranks[word[i : ends[i]]] for i in range(n) if alive[i]]


def word_table(docs: DataFrame, text_col: str, ranks: dict[bytes, int], pattern: str, hot_words: int = HOT_WORDS) -> str:
    """The folder of a table (word, ids): the words that the most documents hold, at most hot_words of them, each folded once."""
    seen = docs.select(F.explode(F.array_distinct(pretokens(F.col(text_col), pattern))).alias("word"))
    counts, _ = materialize_at(seen.groupBy("word").count().where((F.col("count") > 1) & (F.octet_length("word") <= HOT_BYTES)), "bpe-words")
    # A word's level is its count on a scale of eighths of powers of two: a few hundred levels at most.
    level = F.floor(F.log2("count") * 8)
    kept, least = 0, None
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).toLocalIterator():
        if (kept := kept + row["count"]) > hot_words:
            break
        least = row["level"]
    hot = counts.where(level >= (least if least is not None else 1 << 20)).select("word")
    # Cheap words and dear ones are dealt out evenly; the fold is the only work of these tasks.
    hot = hot.repartition(max(8, docs.sparkSession.sparkContext.defaultParallelism * 2))
    _, path = materialize_at(hot.select("word", let(rank_map(ranks), lambda b: fold_word(F.col("word"), b)).alias("ids")), "bpe-hot-words")
    return path


@lru_cache(maxsize=1)
def held_column(path: str, column: str) -> pa.Array:
    """A column of the table of frequent words, read once by a worker; rows stand in the order of the files' names."""
    fs, plain = shared_fs(path)
    read = pq.read_table(plain, columns=[column], filesystem=fs).column(0)
    return pa.concat_arrays(read.chunks) if read.num_chunks else pa.array([], pa.string() if column == "word" else pa.list_(pa.int32()))


def encoder(path: str, ranks: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.Array, pa.ListArray]]]:
    """Batches of (id, words) -> ids and lists of token ids, by the table at path and, for other words, by merges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.ListArray]]:
        hot, known = held_column(path, "word"), held_column(path, "ids")
        starts, values = np.asarray(known.offsets).astype(np.int64), np.asarray(known.values).astype(np.int32)
        rest: dict[str, list[int]] = {}
        for whole in batches:
            for batch in slices(whole, 1, SLICE_BYTES):
                column = batch.column(1)
                bounds = np.asarray(column.offsets).astype(np.int64)
                coded = column.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
                distinct, at = coded.dictionary, np.asarray(coded.indices)
                place = np.asarray(pc.index_in(distinct.cast(hot.type), value_set=hot).fill_null(-1)).astype(np.int64)
                missing = np.flatnonzero(place < 0)
                more: list[list[int]] = []
                if len(rest) > 100_000:
                    rest.clear()
                for word in distinct.take(pa.array(missing)).to_pylist():
                    if (got := rest.get(word)) is None:
                        got = rest[word] = merge_word(word.encode(), ranks)
                    more.append(got)
                # Places of the table, then the words that it lacks.
                place[missing] = len(hot) + np.arange(len(missing))
                length = np.concatenate([np.diff(starts), np.fromiter(map(len, more), np.int64, len(more))])[place]
                rare = np.fromiter(chain.from_iterable(more), np.int32)
                first = np.concatenate([starts[:-1], len(values) + np.cumsum(length[missing]) - length[missing]])[place]
                count = length[at]
                ends = np.concatenate([[0], np.cumsum(count)])
                out = np.concatenate([values, rare])[np.repeat(first[at] - ends[:-1], count) + np.arange(ends[-1])]
                yield batch.column(0), pa.ListArray.from_arrays(pa.array(ends[bounds - bounds[0]].astype(np.int32)), pa.array(out, pa.int32()))

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", hot_words: int = HOT_WORDS) -> DataFrame:
    """(id_col, token_ids array<int>) for every row of docs."""
    small_batches(docs.sparkSession)
    path = word_table(docs, text_col, ranks, pattern, hot_words)
    coded = encoder(path, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, token_ids in coded(batches):
            yield pa.RecordBatch.from_arrays([ids, token_ids], names=[id_col, "token_ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), pretokens(F.col(text_col), pattern).alias("words")).mapInArrow(run, f"{id_col} {kind}, token_ids array<int>")


def piece_table(ranks: dict[bytes, int]) -> pa.Array:
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pa.array(pieces, pa.binary())


def decoded(token_ids: pa.ListArray, pieces: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all rows in one buffer, and where each row starts."""
    bounds = np.asarray(token_ids.offsets).astype(np.int64)
    ids = token_ids.values.slice(bounds[0], bounds[-1] - bounds[0])
    joined = pieces.take(ids.cast(pa.int64()))
    starts = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset : joined.offset + len(joined) + 1]
    data = memoryview(joined.buffers()[2] or b"")
    return data, starts[bounds - bounds[0]] if len(joined) else np.zeros(len(bounds), np.int64)


def decode(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id") -> DataFrame:
    """(id_col, decoded binary) from token_ids."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(sent.value)
        for whole in batches:
            for batch in slices(whole, 1):
                data, starts = decoded(batch.column(1), pieces)
                texts = [bytes(data[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=[id_col, "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "token_ids").mapInArrow(run, f"{id_col} {kind}, decoded binary")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", hot_words: int = HOT_WORDS, with_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256; with_ids: token_ids): encodes, then decodes from the ids alone, in one pass over the texts."""
    small_batches(docs.sparkSession)
    path = word_table(docs, text_col, ranks, pattern, hot_words)
    coded = encoder(path, ranks)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(ranks)
        names = pa.array([str(i) for i in range(len(pieces))])
        for doc_ids, column in coded(batches):
            data, starts = decoded(column, pieces)
            bounds = np.asarray(column.offsets).astype(np.int64)
            text = pc.binary_join(pa.ListArray.from_arrays(column.offsets, names.take(column.values.cast(pa.int64()))), ",")
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids,
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in text]),
                    pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(starts[:-1], starts[1:], strict=True)]),
                    *([column] if with_ids else []),
                ],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", *(["token_ids"] if with_ids else [])],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), pretokens(F.col(text_col), pattern).alias("words")).mapInArrow(digests, f"{id_col} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{", token_ids array<int>" if with_ids else ""}")
