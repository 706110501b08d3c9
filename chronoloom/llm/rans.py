"""Token-id files: a static range asymmetric numeral system over independent interleaved blocks.

Texts are tokenized in ascending id order and packed into blocks of whole documents. One frequency table, counted over
all tokens, is shared by every block. A block's tokens are dealt to LANES interleaved 64-bit states that numpy steps
together; each state emits 32-bit words. A file is a header, blocks with a checksum each, and a trailing directory of
block offsets: checkpoints from which any block is decoded alone. A block longer than CHECK_TOKENS, which one long text
can make, holds the lanes' states at every CHECK_TOKENS tokens as well, so it is decoded in parts.

A folder of files is whole in itself: each file's header holds the frequency table and the digest of the tokenizer, and
the table `files` in the folder names the files that count, since a repeated attempt of a task may leave one more.
Reading needs the folder alone: it takes the blocks from the files' trailing directories and decodes them in parallel.

Defined results: ids are integers (others are refused); null and empty texts have the end id alone; null ids sort first,
rows that share an id by text hash; other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm.common import integer_ids, materialize, new_path, shared_fs, slices, small_batches

#: Tokens at which a block ends (with the document that reaches it), interleaved states, bits of the frequency total.
BLOCK_TOKENS, LANES, SCALE = 1 << 18, 1024, 20
LOW = np.uint64(1 << 31)
MAGIC = b"RANSTOK1"
HEAD = "<8sIIII32s"  # magic, version, vocabulary size, bytes of the frequency table, its crc32, sha256 of the tokenizer
BLOCK = "<QIIIIII"  # first token, tokens, documents, bytes of document table, of checkpoints, of payload, crc32 of all three
TAIL = "<QI8s"  # place of the directory, blocks, magic
#: Tokens between the checkpoints inside a block.
CHECK_TOKENS = 1 << 18
#: Bytes of text that are tokenized together.
SLICE_BYTES = 12 << 20


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a total of 2**SCALE, at least 1 for what occurs."""
    total = counts.sum()
    if not total:
        return np.zeros(len(counts), np.int64)
    scaled = np.maximum(counts * (1 << SCALE) // total, counts > 0)
    over = int(scaled.sum() - (1 << SCALE))
    for at in np.argsort(-scaled):
        if not over:
            break
        step = min(over, int(scaled[at]) - 1) if over > 0 else over
        scaled[at] -= step
        over -= step
    return scaled


def encode_block(ids: np.ndarray, freq: np.ndarray, every: int = CHECK_TOKENS) -> tuple[bytes, bytes]:
    """States and words of one block, and its checkpoints; ids are dealt to the lanes in turn."""
    start = (np.cumsum(freq) - freq).astype(np.uint64)
    freq = freq.astype(np.uint64)
    f, c = freq[ids], start[ids]
    state, words, emitted, marks = np.full(LANES, LOW), [], 0, []
    limit = f << np.uint64(63 - SCALE)
    for at in range((len(ids) - 1) // LANES * LANES, -1, -LANES):
        n = min(LANES, len(ids) - at)
        x, fs = state[:n], f[at : at + n]
        full = x >= limit[at : at + n]
        words.append(x[full].astype("<u4"))
        emitted += len(words[-1])
        x = np.where(full, x >> np.uint64(32), x)
        q = x // fs
        state[:n] = (q << np.uint64(SCALE)) + (x - q * fs) + c[at : at + n]
        if at and at % every == 0:
            marks.append((emitted, state.astype("<u8").tobytes()))
    checkpoints = b"".join(struct.pack("<I", emitted - seen) + kept for seen, kept in marks[::-1])
    return state.astype("<u8").tobytes() + np.concatenate([*words[::-1], np.zeros(0, "<u4")]).astype("<u4").tobytes(), checkpoints


def decode_block(payload: bytes, n_tokens: int, freq: np.ndarray, symbols: np.ndarray, checkpoints: bytes = b"", low: int = 0, high: int | None = None, every: int = CHECK_TOKENS) -> np.ndarray:
    """Tokens low to high of a block, from the last checkpoint before low. symbols[slot] is the id whose range holds the slot."""
    start = (np.cumsum(freq) - freq).astype(np.uint64)
    freq = freq.astype(np.uint64)
    state, at, begin = np.frombuffer(payload, "<u8", LANES).copy(), 0, 0
    words = np.frombuffer(payload, "<u4", offset=8 * LANES)
    high = n_tokens if high is None else high
    if low >= every and checkpoints:
        number = min(low // every, len(checkpoints) // (4 + 8 * LANES))
        (at,) = struct.unpack_from("<I", checkpoints, (number - 1) * (4 + 8 * LANES))
        state, begin = np.frombuffer(checkpoints, "<u8", LANES, (number - 1) * (4 + 8 * LANES) + 4).copy(), number * every
    out, mask = np.empty(max(0, high - begin), np.uint32), np.uint64((1 << SCALE) - 1)
    for first in range(begin, high, LANES):
        n = min(LANES, n_tokens - first)
        x = state[:n]
        slot = x & mask
        ids = symbols[slot]
        x = freq[ids] * (x >> np.uint64(SCALE)) + slot - start[ids]
        short = np.flatnonzero(x < LOW)
        x[short] = (x[short] << np.uint64(32)) | words[at : at + len(short)]
        at += len(short)
        state[:n] = x
        out[first - begin : first - begin + n] = ids[: high - first]
    if high == n_tokens and (at != len(words) or (state != LOW).any()):
        raise ValueError("the block does not end in its first state")
    return out[low - begin :]


#: Pieces that are tokenized as one text, and pieces of one call.
JOINED, LOT = 64, 10_000
#: Letters of Latin scripts without marks of their own, ASCII punctuation but the apostrophe; a piece of letters that
#: punctuation may follow.
LETTERS = "".join(chr(c) for c in range(0x250) if chr(c).isalpha() and c not in (0xAA, 0xBA, 0x130))
PUNCTUATION = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27)
WORD_AND_TAIL = rf"^(?P<head>[{LETTERS}]+)(?P<tail>[{re.escape(PUNCTUATION)}]*)$"


def for_words(definition: str):
    """For words of LETTERS in lower case: the same tokenizer with no normalizer and parted at spaces alone, and which ids
    end a word. None unless it does as the whole one does on every letter and pair of neighbours in either case, each
    word's last token and no other has the suffix of a word's end, and punctuation parts from letters."""
    import tokenizers

    whole, changed = tokenizers.Tokenizer.from_str(definition), json.loads(definition)
    steps, suffix = (changed["pre_tokenizer"] or {}).get("pretokenizers"), changed["model"].get("end_of_word_suffix")
    if not steps or not suffix:
        return None
    changed["normalizer"] = None
    changed["pre_tokenizer"]["pretokenizers"] = [{"type": "CharDelimiterSplit", "delimiter": " "}, *[x for x in steps if x["type"] != "Split"]]
    light = tokenizers.Tokenizer.from_str(json.dumps(changed))
    ends = np.zeros(whole.get_vocab_size(), bool)
    ends[[at for token, at in whole.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True
    coded = lambda by, text: by.encode(text, add_special_tokens=False).ids
    tried = [*LETTERS, *map("".join, zip(LETTERS, LETTERS[1:] + LETTERS[:1], strict=True))]
    lower = pc.utf8_lower(pa.array(tried)).to_pylist()
    pieces = [coded(whole, x) for x in tried]
    same = coded(light, " ".join(lower)) == sum(pieces, []) and all(ids and ends[ids].sum() == 1 and ends[ids[-1]] for ids in pieces)
    parted = all(coded(whole, "a" + x + y) == coded(whole, "a") + coded(whole, x + y) for x in PUNCTUATION for y in ("", *PUNCTUATION))
    return (light, ends) if same and parted else None


def word_ids(tokenizer, ends: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after another, and the number of each. Words share a text, cut at the ids that end a word."""
    pools, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for first in range(0, len(words), LOT):
        lot = words[first : first + LOT]
        texts = [" ".join(lot[at : at + JOINED]) for at in range(0, len(lot), JOINED)]
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        last = np.flatnonzero(ends[ids])
        if len(last) != len(lot) or last[-1] + 1 != len(ids):
            raise ValueError("a word of letters has not become one word of the tokenizer")
        pools.append(ids)
        sizes.append(np.diff(last, prepend=-1))
    return np.concatenate(pools), np.concatenate(sizes)


def separator(tokenizer) -> tuple[str, int] | None:
    """A special token that parts a text before anything else looks at it, and its id."""
    for at, token in tokenizer.get_added_tokens_decoder().items():
        if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word):
            return token.content, at
    return None


def tokenized(tokenizer, pieces: list[str]) -> Iterator[list[int]]:
    """The ids of each piece. Pieces share a text, cut at the separator's ids; where a piece holds the separator, each stands alone."""
    mark, mark_id = separator(tokenizer) or (None, None)
    step = JOINED if mark else 1
    for first in range(0, len(pieces), LOT):
        groups = [pieces[at : min(at + step, first + LOT)] for at in range(first, min(first + LOT, len(pieces)), step)]
        texts = [mark.join(g) for g in groups] if mark else [g[0] for g in groups]
        for group, found in zip(groups, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = found.ids
            if ids.count(mark_id) != len(group) - 1:
                yield from (x.ids for x in tokenizer.encode_batch_fast(group, add_special_tokens=False))
                continue
            at = 0
            for _ in group[1:]:
                end = ids.index(mark_id, at)
                yield ids[at:end]
                at = end + 1
            yield ids[at:]


def load_tokenizer(definition: str):
    """One tokenizer for a worker process, on one thread: Spark has dealt out the cores. With it, its form for words."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    held = vars(tokenizers).setdefault("_held_by_definition", {})
    key = hash(definition)
    if key not in held:
        held.clear()
        held[key] = tokenizers.Tokenizer.from_str(definition), for_words(definition)
    return held[key]


def gather(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """pool[start : start + length] of every entry, one after another."""
    ends = np.cumsum(length)
    where = np.repeat(start - (ends - length), length)
    where += np.arange(len(where))
    return pool[where]


def piece_ids(tokenizer, by_word, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces, one after another, and the number of each. A word of letters with punctuation after it is
    looked up as two units, the word in lower case; any other piece is one. Each distinct unit is tokenized once."""
    parted = pc.extract_regex(pieces, WORD_AND_TAIL if by_word else "^(?P<head>)(?P<tail>)$")
    simple = np.asarray(pc.is_valid(parted))
    heads = pc.if_else(parted.is_valid(), pc.utf8_lower(pc.struct_field(parted, "head")), pieces)
    tails = pc.if_else(parted.is_valid(), pc.struct_field(parted, "tail"), pa.scalar("", pieces.type))
    coded = pa.concat_arrays([heads, tails]).dictionary_encode()
    at = np.asarray(coded.indices)
    is_word = np.zeros(len(coded.dictionary), bool)
    if by_word:
        is_word[at[: len(pieces)][simple]] = True
    words, others = np.flatnonzero(is_word), np.flatnonzero(~is_word)
    pool, sizes = word_ids(*by_word, coded.dictionary.take(pa.array(words)).to_pylist()) if by_word else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    rest, rest_sizes = array("I"), []
    for first in range(0, len(others), LOT):
        for ids in tokenized(tokenizer, coded.dictionary.take(pa.array(others[first : first + LOT])).to_pylist()):
            rest.extend(ids)
            rest_sizes.append(len(ids))
    pool = np.concatenate([pool, np.frombuffer(rest, np.uint32)])
    length = np.zeros(len(is_word), np.int64)
    start = np.zeros(len(is_word), np.int64)
    length[words], length[others] = sizes, np.array(rest_sizes, np.int64)
    order = np.concatenate([words, others])
    start[order] = np.cumsum(length[order]) - length[order]
    units = at.reshape(2, len(pieces)).T
    return gather(pool, start[units].ravel(), length[units].ravel()), length[units].sum(1)


def token_blocks(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(part, block, first_token within the part, ids binary, doc_ids, lengths): whole documents in ascending id order."""
    integer_ids(docs, id_col)
    small_batches(docs.sparkSession)
    with open(tokenizer_path) as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    keys = [F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)]
    rows = docs.select(id_col, text_col).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, by_word = load_tokenizer(definition.value)
        part, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        doc_ids, lengths = [], []

        def row() -> pa.RecordBatch:
            nonlocal block, first, held, doc_ids, lengths
            ids = np.concatenate(held).astype("<u4")
            out = pa.RecordBatch.from_pydict(
                {"part": [part], "block": [block], "first_token": [first], "ids": [ids.tobytes()], "doc_ids": [doc_ids], "lengths": [lengths]},
                schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_token", pa.int64()), ("ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32()))]),
            )
            block, first, held, doc_ids, lengths = block + 1, first + len(ids), [], [], []
            return out

        def together(all_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting, size = [], 0
            for batch in all_batches:
                waiting.append(batch)
                size += batch.nbytes
                if size >= SLICE_BYTES:
                    yield pa.concat_batches(waiting)
                    waiting, size = [], 0
            if waiting:
                yield pa.concat_batches(waiting)

        for whole in together(batches):
            for batch in slices(whole, 1, 2 * SLICE_BYTES):
                # The tokenizer drops white space and never joins what it parts, so texts are cut there and each
                # distinct piece is tokenized once.
                pieces = pc.ascii_split_whitespace(pc.fill_null(batch.column(1), ""))
                bounds = np.asarray(pieces.offsets).astype(np.int64)
                coded = pieces.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
                at = np.asarray(coded.indices)
                pool, length = piece_ids(tokenizer, by_word, coded.dictionary)
                count = length[at]
                flat = gather(pool, (np.cumsum(length) - length)[at], count)
                cuts = np.concatenate([[0], np.cumsum(count)])[bounds - bounds[0]]
                for doc, a, b in zip(batch.column(0).to_pylist(), cuts[:-1], cuts[1:], strict=True):
                    held.append(np.append(flat[a:b], np.uint32(end_id)))
                    doc_ids.append(doc)
                    lengths.append(int(b - a) + 1)
                    if sum(lengths[-1:]) >= block_tokens or (len(lengths) % 16 == 0 and sum(lengths) >= block_tokens):
                        yield row()
                del batch, pieces, coded, at, pool, length, count, flat
                pa.default_memory_pool().release_unused()
        if held:
            yield row()

    return rows.mapInArrow(run, "part int, block int, first_token bigint, ids binary, doc_ids array<bigint>, lengths array<int>")


def token_counts(blocks: DataFrame) -> DataFrame:
    """(id, n) over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                seen = np.bincount(np.frombuffer(ids, "<u4"))
                if len(seen) > len(total):
                    total = np.append(total, np.zeros(len(seen) - len(total), np.int64))
                total[: len(seen)] += seen
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["id", "n"])

    return blocks.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS, check_tokens: int = CHECK_TOKENS) -> str:
    """Writes the files; the folder that holds them and the table `files` of their names."""
    spark = docs.sparkSession
    blocks = materialize(token_blocks(docs, tokenizer_path, end_id, id_col, text_col, block_tokens), "token-blocks")
    counts = np.zeros(vocabulary, np.int64)
    for row in token_counts(blocks).collect():  # at most the vocabulary
        counts[row["id"]] = row["n"]
    freq = frequencies(counts)
    totals = blocks.groupBy("part").agg(F.sum(F.octet_length("ids") / 4).cast("bigint").alias("n")).orderBy("part").collect()  # one row a partition
    before, starts = 0, {}
    for row in totals:
        starts[row["part"]], before = before, before + row["n"]
    with open(tokenizer_path, "rb") as file:
        digest = hashlib.sha256(file.read()).digest()
    table = zlib.compress(freq.astype("<u4").tobytes())
    head = struct.pack(HEAD, MAGIC, 2, vocabulary, len(table), zlib.crc32(table), digest) + table
    sent = spark.sparkContext.broadcast((freq, starts, head))
    folder = new_path(spark, "tokens")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, first, _ = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<u4")
                named = [0 if x is None else x for x in row["doc_ids"]]
                docs_table = np.array(named, "<i8").tobytes() + np.array(row["lengths"], "<u4").tobytes() + np.array([x is None for x in row["doc_ids"]], np.uint8).tobytes()
                payload, marks = encode_block(ids, table, check_tokens)
                crc = zlib.crc32(payload, zlib.crc32(marks, zlib.crc32(docs_table)))
                front = struct.pack(BLOCK, first[row["part"]] + row["first_token"], len(ids), len(named), len(docs_table), len(marks), len(payload), crc)
                yield pa.RecordBatch.from_pydict(
                    {"part": [row["part"]], "block": [row["block"]], "data": [front + docs_table + marks + payload]}, schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("data", pa.binary())])
                )

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_part, out, offsets, path = None, None, [], ""

        def close() -> pa.RecordBatch:
            out.write(np.array(offsets, "<u8").tobytes() + struct.pack(TAIL, out.tell(), len(offsets), MAGIC))
            out.close()
            return pa.RecordBatch.from_pydict({"part": [open_part], "file": [path], "blocks": [len(offsets)]}, schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("blocks", pa.int64())]))

        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if part != open_part:
                    if out is not None:
                        yield close()
                    path = f"{folder}/tokens-{part:06d}-{uuid.uuid4().hex}.rans"
                    fs, plain = shared_fs(path)
                    fs.create_dir(plain.rsplit("/", 1)[0], recursive=True)
                    out, open_part, offsets = fs.open_output_stream(plain, compression=None), part, []
                    out.write(sent.value[2])
                offsets.append(out.tell())
                out.write(data.as_buffer())
        if out is not None:
            yield close()

    packed = blocks.select("part", "block", "first_token", "ids", "doc_ids", "lengths").mapInArrow(pack, "part int, block int, data binary")
    packed.repartition("part").sortWithinPartitions("part", "block").mapInArrow(lay, "part int, file string, blocks bigint").write.parquet(f"{folder}/files")
    return folder


@lru_cache(maxsize=2)
def frequency_table(packed: bytes, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """The table of a header, and the id of each slot."""
    table = np.frombuffer(zlib.decompress(packed), "<u4", vocabulary).astype(np.int64)
    return table, np.repeat(np.arange(vocabulary, dtype=np.uint32), table)


def read(spark: SparkSession, folder: str, id_col: str = "doc_id", check_tokens: int = CHECK_TOKENS) -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of every document, decoded from the files of a folder, block by block."""
    small_batches(spark)

    def directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, plain = shared_fs(path)
                with fs.open_input_file(plain) as file:
                    size, tail = file.size(), struct.calcsize(TAIL)
                    at, n, magic = struct.unpack(TAIL, file.read_at(tail, size - tail))
                    if magic != MAGIC or at + 8 * n + tail != size:
                        raise ValueError(f"{path} has no directory of blocks")
                    offsets = np.frombuffer(file.read_at(8 * n, at), "<u8").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(offsets), pa.array(np.diff(offsets, append=at))], names=["file", "offset", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, plain = shared_fs(row["file"])
                with fs.open_input_file(plain) as file:
                    magic, version, vocabulary, n_table, crc, _ = struct.unpack(HEAD, file.read_at(struct.calcsize(HEAD), 0))
                    packed = file.read_at(n_table, struct.calcsize(HEAD))
                    data = file.read_at(row["length"], row["offset"])
                if (magic, version, crc) != (MAGIC, 2, zlib.crc32(packed)):
                    raise ValueError(f"{row['file']} has no whole header")
                table, symbols = frequency_table(packed, vocabulary)
                first, n_tokens, n_docs, n_names, n_marks, n_payload, crc = struct.unpack_from(BLOCK, data)
                body = memoryview(data)[struct.calcsize(BLOCK) :]
                names, marks, payload = body[:n_names], body[n_names : n_names + n_marks], body[n_names + n_marks :]
                if len(payload) != n_payload or zlib.crc32(payload, zlib.crc32(marks, zlib.crc32(names))) != crc:
                    raise ValueError(f"checksum of the block at {row['offset']} of {row['file']}")
                lengths = np.frombuffer(names, "<u4", n_docs, 8 * n_docs).astype(np.int64)
                ends = np.cumsum(lengths)
                crcs = [0] * n_docs
                for low in range(0, n_tokens, check_tokens):
                    # A part of a long block at a time; a document's checksum goes on from part to part.
                    high = min(low + check_tokens, n_tokens)
                    part = decode_block(payload, n_tokens, table, symbols, bytes(marks), low, high, check_tokens).astype("<u4")
                    for doc in range(int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high - 1, "right")) + 1):
                        crcs[doc] = zlib.crc32(part[max(0, ends[doc] - lengths[doc] - low) : ends[doc] - low].tobytes(), crcs[doc])
                named = pa.array(np.frombuffer(names, "<i8", n_docs), pa.int64(), mask=np.frombuffer(names, np.uint8, n_docs, 12 * n_docs).astype(bool))
                yield pa.RecordBatch.from_arrays([named, pa.array(first + ends - lengths, pa.int64()), pa.array(lengths), pa.array(crcs, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

    files = spark.read.schema("part int, file string, blocks bigint").parquet(f"{folder}/files").select("file")
    cores = spark.sparkContext.defaultParallelism
    blocks = files.repartition(cores * 2, F.xxhash64("file")).mapInArrow(directory, "file string, offset bigint, length bigint")
    return blocks.repartition(cores * 4, F.xxhash64("file", "offset")).mapInArrow(run, f"{id_col} bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
