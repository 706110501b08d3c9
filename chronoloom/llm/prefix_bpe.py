"""BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a word has one BPE encoding, and so one last token. It is the only token that ends there, matches the text
and is compatible with the last token of the prefix before it. An automaton over the vocabulary (suffix links, as of Aho
and Corasick) names the longest token that ends at each byte, and each token names the next shorter one that ends it; the
first compatible one is stored, and back-pointers from the end of the word give the ids. Two tokens are compatible if
merging their bytes gives just the two: their merges are undone from the last to the first, and no pair across the border
may have a rank that would have come earlier (of equal ranks the left place comes first).

All distinct words of a batch of texts take a step together, byte by byte, in numpy arrays; when only few long words are
left, these go on one by one. Work is linear in the bytes times the tokens that end at a byte, whatever a word's length.

Texts are cut by the pattern in the JVM; a special token's text in a document is that token, and parts the text around it as
the ends of a text would. Nothing is shuffled, and a task holds one slice of words.

Defined results: a null text counts as empty; an empty text has no ids; repeated rows give repeated results; ids that are no
valid UTF-8 decode with replacement characters; an empty table gives no rows; only the id and text columns are looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.bpe import decoded, jvm_pattern
from chronoloom.llm.common import slices, small_batches

#: Bytes of words that a task holds at once; words that still have bytes to go, below which they go on one by one.
SLICE_BYTES, FEW = 16 << 20, 12
_NEVER = np.int64(2**62)
_FILTER_BITS = 21


@dataclass(frozen=True)
class Model:
    """A vocabulary with its merges and automaton, in arrays by token id (left, right, rank, size, shorter, usable) and by
    state (fail, longest); edges are sorted state * 256 + byte."""

    pieces: list[bytes]
    special: dict[str, int]
    left: np.ndarray
    right: np.ndarray
    rank: np.ndarray
    size: np.ndarray
    pairs: np.ndarray
    pair_rank: np.ndarray
    pair_filter: np.ndarray
    shorter: np.ndarray
    edges: np.ndarray
    targets: np.ndarray
    fail: np.ndarray
    longest: np.ndarray


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it is printed, else the next from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in printed}
    rest = [b for b in range(256) if b not in set(printed)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


def read_model(path: str) -> Model:
    """A byte-level vocabulary in the tokenizers library's JSON. Each token but the bytes needs one merge, of parts merged before it."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters, vocabulary = byte_letters(), spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    n = max([*vocabulary.values(), *special.values()]) + 1
    pieces = [b""] * n
    for token, at in vocabulary.items():
        if token not in special:
            pieces[at] = bytes(letters[c] for c in token)
    for token, at in special.items():
        pieces[at] = token.encode()
    left, right, rank = np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for place, merge in enumerate(spec["model"]["merges"]):
        a, b = (vocabulary[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
        made = vocabulary[(merge if isinstance(merge, str) else " ".join(merge)).replace(" ", "", 1)]
        if left[made] >= 0 or any(len(pieces[x]) > 1 and rank[x] < 0 for x in (a, b)):
            raise ValueError(f"token {made} has two merges, or parts that are merged later")
        left[made], right[made], rank[made] = a, b, place
    order = np.argsort(left * n + right, kind="stable")
    order = order[rank[order] >= 0]
    pairs = (left * n + right)[order]
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[filter_place(pairs)] = True
    parts = (pieces, special, left, right, rank, np.array([len(p) for p in pieces], np.int64), pairs, rank[order], seen)
    usable = [bool(p) and i not in set(special.values()) for i, p in enumerate(pieces)]
    usable = np.array(usable) & reachable(Model(*parts, *[np.zeros(0, np.int64)] * 5))
    return Model(*parts, *automaton(pieces, usable))


def filter_place(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def reachable(model: Model) -> np.ndarray:
    """Whether merging a token's own bytes gives the token."""
    made = np.flatnonzero(model.rank >= 0)
    made = made[np.argsort(model.rank[made])]
    own = np.ones(len(model.rank), bool)
    own[made] = compatible(model, model.left[made], model.right[made], model.rank[made])
    for t in made[own[made]]:  # parts come before the whole
        own[t] = own[model.left[t]] and own[model.right[t]]
    return own


def automaton(pieces: list[bytes], usable: np.ndarray) -> tuple[np.ndarray, ...]:
    """(shorter, edges, targets, fail, longest)."""
    children: list[dict[int, int]] = [{}]
    token = [-1]
    for t in np.flatnonzero(usable):
        state = 0
        for byte in pieces[t]:
            if (following := children[state].get(byte)) is None:
                following = children[state][byte] = len(children)
                children.append({})
                token.append(-1)
            state = following
        token[state] = int(t)
    fail, longest, shorter = np.zeros(len(children), np.int64), np.full(len(children), -1, np.int64), np.full(len(pieces), -1, np.int64)
    waiting = deque([0])
    while waiting:
        state = waiting.popleft()
        for byte, child in children[state].items():
            back = int(fail[state])
            while state and back and byte not in children[back]:
                back = int(fail[back])
            fail[child] = children[back].get(byte, 0) if state else 0
            longest[child] = token[child] if token[child] >= 0 else longest[fail[child]]
            if token[child] >= 0:
                shorter[token[child]] = longest[fail[child]]
            waiting.append(child)
    edges = np.array([s * 256 + b for s, own in enumerate(children) for b in own], np.int64)
    targets = np.array([c for own in children for c in own.values()], np.int64)
    order = np.argsort(edges)
    return shorter, edges[order], targets[order], fail, longest


def rank_of(model: Model, pairs: np.ndarray) -> np.ndarray:
    """Ranks of pairs of tokens (left * n + right); _NEVER for those without a merge."""
    out = np.full(len(pairs), _NEVER)
    maybe = np.flatnonzero(model.pair_filter[filter_place(pairs)])
    at = np.minimum(np.searchsorted(model.pairs, pairs[maybe]), len(model.pairs) - 1)
    hit = model.pairs[at] == pairs[maybe]
    out[maybe[hit]] = model.pair_rank[at[hit]]
    return out


def compatible(model: Model, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
    """Whether tokens a and b stay two when their bytes are merged (by merges before the rank `until`, if it is given)."""
    n, out = len(model.rank), np.ones(len(a), bool)
    at, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
    # Ranks at which the piece left, or right, of the border went into a larger one.
    x_until = np.full(len(a), _NEVER) if until is None else until.astype(np.int64)
    y_until = x_until if until is None else x_until - 1
    while len(at):
        found = rank_of(model, x * n + y)
        clash = (found < x_until) & (found <= y_until)
        out[at[clash]] = False
        go = ~clash & ((model.rank[x] >= 0) | (model.rank[y] >= 0))
        at, x, y, x_until, y_until = at[go], x[go], y[go], x_until[go], y_until[go]
        undo = model.rank[x] > model.rank[y]
        x_until, y_until = np.where(undo, model.rank[x], x_until), np.where(undo, y_until, model.rank[y])
        x, y = np.where(undo, model.right[x], x), np.where(undo, y, model.left[y])
    return out


def advance(model: Model, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """The automaton's states after one more byte each."""
    out, at, state = np.zeros(len(state), np.int64), np.arange(len(state)), state
    while len(at):
        keys = state * 256 + byte[at]
        place = np.minimum(np.searchsorted(model.edges, keys), len(model.edges) - 1)
        hit = model.edges[place] == keys
        out[at[hit]] = model.targets[place[hit]]
        go = ~hit & (state > 0)
        at, state = at[go], model.fail[state[go]]
    return out


class Encoder:
    """Encodes words by a model; remembers pairs that were tested one by one."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.tested: dict[tuple[int, int], bool] = {}
        self.steps: dict[tuple[int, int], int] = {}

    def one(self, word: np.ndarray, last: np.ndarray, begin: int, state: int) -> None:
        """Goes on with one word from the byte `begin`; last is filled in place."""
        model, fits, steps = self.model, self.tested, self.steps
        longest, shorter, size = model.longest, model.shorter, model.size
        for p in range(begin, len(word)):
            key = (state, int(word[p]))
            if (following := steps.get(key)) is None:
                following = steps[key] = int(advance(model, np.array([state]), np.array([key[1]]))[0])
            state, token = following, int(longest[following])
            while token >= 0:
                before = p - int(size[token])
                if before < 0:
                    break
                pair = (int(last[before]), token)
                if (fit := fits.get(pair)) is None:
                    fit = fits[pair] = bool(compatible(model, np.array([pair[0]]), np.array([token]))[0])
                if fit:
                    break
                token = int(shorter[token])
            last[p] = token
        if len(steps) > 1 << 18:
            steps.clear()
        if len(fits) > 1 << 18:
            fits.clear()

    def last_tokens(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The last token of every prefix of words, which lie one after another in flat from starts on."""
        model, last = self.model, np.full(len(flat), -1, np.int64)
        lengths = np.diff(starts)
        order = np.argsort(-lengths, kind="stable")
        begins, lengths = starts[:-1][order], lengths[order]
        state = np.zeros(len(order), np.int64)
        p, live = 0, int(np.searchsorted(-lengths, 0, side="left"))
        while live >= FEW:
            begin = begins[:live]
            state = advance(model, state[:live], flat[begin + p].astype(np.int64))
            open_, token = np.arange(live), model.longest[state]
            while len(open_):
                before = p - model.size[token]
                fit = before < 0
                test = np.flatnonzero(~fit)
                fit[test] = compatible(model, last[begin[open_[test]] + before[test]], token[test])
                last[begin[open_[fit]] + p] = token[fit]
                open_, token = open_[~fit], model.shorter[token[~fit]]
                there = token >= 0
                open_, token = open_[there], token[there]
            p += 1
            live = int(np.searchsorted(-lengths, -p, side="left"))
        for row in range(live):
            where = slice(begins[row], begins[row] + lengths[row])
            self.one(flat[where], last[where], p, int(state[row]) if p else 0)
        if (last < 0).any():
            raise ValueError("a prefix has no last token: the vocabulary lacks bytes")
        return last

    def encode(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): token ids of all words, and where each word's begin. A special token's text is that token."""
        model = self.model
        words = words.cast(pa.large_binary())
        starts = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = words.buffers()[2]
        flat = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.zeros(0, np.uint8)
        starts = starts - starts[0]
        marks = {at: model.special[w.decode()] for at, w in enumerate(words.to_pylist()) if w.decode() in model.special} if model.special else {}
        last = self.last_tokens(flat, starts)
        # Back-pointers, one token a step, for all words together.
        ends, found = starts[1:].copy(), []
        open_ = np.flatnonzero(ends > starts[:-1])
        while len(open_):
            token = last[ends[open_] - 1]
            found.append((open_, token))
            ends[open_] -= model.size[token]
            open_ = open_[ends[open_] > starts[:-1][open_]]
        row = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
        token = np.concatenate([t for _, t in found]) if found else np.zeros(0, np.int64)
        step = np.repeat(np.arange(len(found)), [len(r) for r, _ in found])
        if marks:
            plain = ~np.isin(row, list(marks))
            row, token, step = np.concatenate([row[plain], list(marks)]), np.concatenate([token[plain], list(marks.values())]), np.concatenate([step[plain], np.zeros(len(marks), np.int64)])
        placed = np.lexsort((-step, row))
        bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(words)))])
        return token[placed].astype(np.int32), bounds


def pretokens(text: Column, pattern: str, special: list[str]) -> Column:
    """Words of a text by the pattern, with the special tokens' texts as words of their own."""
    matches = lambda part: F.regexp_extract_all(part, F.lit(jvm_pattern(pattern)), F.lit(0))
    whole = F.coalesce(text, F.lit(""))
    if not special:
        return matches(whole)
    either = "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))
    marks = F.regexp_extract_all(whole, F.lit(either), F.lit(0))
    parts = F.transform(F.split(whole, either, -1), lambda part, i: F.concat(matches(part), F.when(i < F.size(marks), F.array(F.get(marks, i))).otherwise(F.array().cast("array<string>"))))
    return F.when(F.size(marks) == 0, matches(whole)).otherwise(F.flatten(parts))


def coder(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.Array, pa.ListArray]]]:
    """Batches of (id, words) -> ids and lists of token ids; each distinct word of a slice is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.ListArray]]:
        encoder = Encoder(sent.value)
        for whole in batches:
            for batch in slices(whole, 1, SLICE_BYTES):
                column = batch.column(1)
                bounds = np.asarray(column.offsets).astype(np.int64)
                coded = column.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
                ids, starts = encoder.encode(coded.dictionary)
                at = np.asarray(coded.indices)
                count = np.diff(starts)[at]
                ends = np.concatenate([[0], np.cumsum(count)])
                out = ids[np.repeat(starts[:-1][at] - ends[:-1], count) + np.arange(ends[-1])]
                yield batch.column(0), pa.ListArray.from_arrays(pa.array(ends[bounds - bounds[0]].astype(np.int32)), pa.array(out, pa.int32()))

    return run


def words_of(docs: DataFrame, model: Model, pattern: str, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col), pretokens(F.col(text_col), pattern, list(model.special)).alias("words"))


def encode(docs: DataFrame, model: Model, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, token_ids array<int>) for every row of docs."""
    small_batches(docs.sparkSession)
    coded = coder(docs.sparkSession.sparkContext.broadcast(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, token_ids in coded(batches):
            yield pa.RecordBatch.from_arrays([ids, token_ids], names=[id_col, "token_ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return words_of(docs, model, pattern, id_col, text_col).mapInArrow(run, f"{id_col} {kind}, token_ids array<int>")


def texts_of(token_ids: pa.ListArray, pieces: pa.Array) -> list[str]:
    data, starts = decoded(token_ids, pieces)
    return [bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(starts[:-1], starts[1:], strict=True)]


def decode(encoded: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(id_col, decoded string) from token_ids; special tokens stay."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(sent.value.pieces, pa.binary())
        for whole in batches:
            for batch in slices(whole, 1):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts_of(batch.column(1), pieces), pa.string())], names=[id_col, "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "token_ids").mapInArrow(run, f"{id_col} {kind}, decoded string")


def round_trip(docs: DataFrame, model: Model, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): encodes, then decodes from the ids alone, in one pass over the texts."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    coded = coder(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(sent.value.pieces, pa.binary())
        for doc_ids, column in coded(batches):
            bounds = np.asarray(column.offsets).astype(np.int64)
            raw = np.asarray(column.values).astype("<u4")
            digests = [hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            texts = [hashlib.sha256(t.encode()).hexdigest() for t in texts_of(column, pieces)]
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(np.diff(bounds), pa.int64()), pa.array(digests), pa.array(texts)], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return words_of(docs, model, pattern, id_col, text_col).mapInArrow(run, f"{id_col} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
