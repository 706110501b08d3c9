"""BPE by prefixes, the prefix trie and importance resampling against the libraries and brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronoloom.llm import importance, prefix_bpe, prefix_trie

EMPTY = hashlib.sha256(b"").hexdigest()
TEXTS = [
    (1, "The quick brown fox's den <|endoftext|>  twice<|endoftext|>"),
    (2, None),
    (3, ""),
    (4, "héllo wörld  日本語 tabs\tand\n\nlines    " * 30),
    (4, "héllo wörld  日本語 tabs\tand\n\nlines    " * 30),
    (5, "x" * 20_000 + " " * 3000 + "=-" * 2000 + "aaaab" * 500 + " 1234567"),
    (6, "<|endoftext|>"),
    (None, "no id, but <|endoftext| > words"),
]


@pytest.fixture(scope="module")
def model():
    return prefix_bpe.read_model(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*row, "x", [1]) for row in TEXTS], "doc_id long, text string, words string, token_ids array<int>")


def test_prefix_bpe_agrees_with_the_library(docs, model, tokenizer):
    want = sorted((i or 0, tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in TEXTS)
    encoded = prefix_bpe.encode(docs, model, public_tokenizers.PATTERN)
    assert sorted((r["doc_id"] or 0, list(r["token_ids"])) for r in encoded.collect()) == want
    back = sorted((r["doc_id"] or 0, r["decoded"]) for r in prefix_bpe.decode(encoded, model).collect())
    assert back == sorted((i or 0, t or "") for i, t in TEXTS)
    for row in prefix_bpe.round_trip(docs.where("doc_id = 5"), model, public_tokenizers.PATTERN).collect():
        ids = tokenizer.encode(TEXTS[5][1], add_special_tokens=False).ids
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert row["decoded_sha256"] == hashlib.sha256(TEXTS[5][1].encode()).hexdigest()
    assert prefix_bpe.round_trip(docs.where("doc_id > 99"), model, public_tokenizers.PATTERN).count() == 0


def test_prefix_bpe_on_every_code_point(spark, model, tokenizer):
    texts = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)} " for c in range(k, k + 64) if not 0xD800 <= c < 0xE000) for k in range(0, 0x110000, 64)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(8)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert all(list(r["token_ids"]) == want[r["doc_id"]] for r in prefix_bpe.encode(frame, model, public_tokenizers.PATTERN).collect())


def test_prefix_bpe_few_words_and_many_agree(model, tokenizer):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("etaoinshrlé日="), size=n)) for n in rng.integers(1, 60, 300)]
    encoder = prefix_bpe.Encoder(model)
    ids, bounds = encoder.encode(pa.array(words))
    together = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert together == [encoder.encode(pa.array([w]))[0].tolist() for w in words]


def test_undecodable_ids_become_replacement_characters(spark, model, tokenizer):
    ids = [[220, 222], [50256, 64], [], [100, 220]]
    frame = spark.createDataFrame(list(enumerate(ids)), "doc_id int, token_ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in prefix_bpe.decode(frame, model).collect()}
    assert [got[i] for i in range(4)] == [tokenizer.decode(x, skip_special_tokens=False) for x in ids]


def plain_trie(rows, every=5, most=9):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = convs.get(c - int(math.fmod(c, every)), [])[:h] + own[h:]
    members, ended, kids = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(set)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
            if d:
                kids[tuple(said[: d - 1])].add(tuple(said[:d]))
        ended[tuple(said)].append(c)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (min(held), len(n), min(members[n[:-1]]) if n else -1, len(held), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ended[n]))).encode()).hexdigest())
        for n, held in members.items()
    )


def found(frame):
    order = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if r[c] is None else r[c] for c in order) for r in frame.collect())


SAID = "conv_id long, turn int, role string, text string"


def test_trie_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(-6, 60):
        for turn in range(int(rng.integers(0, 12))):
            # Few different texts, so that beginnings repeat; turns tie and lack numbers.
            rows.append((c, None if rng.random() < 0.1 else turn, str(rng.choice(["user", "bot"])) if turn % 3 else None, str(rng.choice(["", "hé", "b" * 50])) if turn > 1 else "start"))
    rows += [(7, 0, "user", "again")] * 3 + [(None, 1, "user", "no conversation"), (300, 0, None, None)] + [(100 + c, t, "u", "same") for c in range(40) for t in range(6)]
    # One conversation holds a third of all rows.
    rows += [(20, t, "user", f"t{t % 7}") for t in range(len(rows) // 2)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SAID + ", depth int, ka string").repartition(5)
    want = plain_trie(rows)
    for most in (1 << 17, 3):
        assert found(prefix_trie.trie(*prefix_trie.with_shared_heads(prefix_trie.placed(frame)), shard_rows=most)) == want


def test_trie_without_conversations_or_turns(spark):
    none = spark.createDataFrame([], SAID)
    assert prefix_trie.trie(*prefix_trie.with_shared_heads(prefix_trie.placed(none))).count() == 0
    short = [(c, 0, "u", "x") for c in range(1001, 1040) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    got = found(prefix_trie.trie(*prefix_trie.with_shared_heads(prefix_trie.placed(spark.createDataFrame(short, SAID)))))
    assert got == plain_trie(short) and len(got) == 1
    # Without shared heads, each conversation as it is.
    plain = found(prefix_trie.trie(prefix_trie.placed(spark.createDataFrame(short, SAID))))
    assert [x[:6] for x in plain] == [(short[0][0], 0, -1, len(short), 1, 1), (short[0][0], 1, short[0][0], len(short), 0, 1)]


def test_find_close_against_a_stack():
    rng = np.random.default_rng(2)
    for n in (1, 5, 63, 64, 65, 5000):
        steps, depth = [], 0
        for left in range(2 * n, 0, -1):
            up = depth == 0 or (depth < left and rng.random() < (0.9 if (left // 200) % 2 else 0.5))
            steps.append(int(up))
            depth += 1 if up else -1
        opens, want, stack = np.flatnonzero(steps), {}, []
        for at, up in enumerate(steps):
            if up:
                stack.append(at)
            else:
                want[stack.pop()] = at
        assert prefix_trie.Parens(np.array(steps, np.uint8)).find_close(opens).tolist() == [want[o] for o in opens.tolist()]


def plain_resample(rows, target, least=20, percent=10, buckets=10_000):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    at = lambda t: [zlib.crc32(w.encode()) % buckets for w in word.findall(lower(t))]
    own, wanted = [(i, at(t)) for i, t in rows], collections.Counter(b for t in target for b in at(t))
    seen = collections.Counter(b for _, x in own for b in x)
    s, t = seen.total(), wanted.total()
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((seen[b] + 1) * (t + buckets))))
    out = []
    for i, x in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, x))
        out.append((i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = fit[: len(fit) * percent // 100]
    return out, drawn


def test_resample_against_brute_force(spark):
    rng = np.random.default_rng(9)
    words = ["Alpha", "beta", "gämma", "delta9", "ΕΨΙΛΟΝ", "zeta", "x\x00y", "a-b"]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 60))))) for i in range(300)]
    rows += [(7, rows[7][1])] * 5 + [(None, rows[3][1]), (900, None), (901, ""), (902, "delta9 " * 30_000)] + [(1000, "zeta " * 40)] * 30
    target = ["ALPHA beta alpha", None, "zeta"]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rank int, score string").repartition(7)
    wanted = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id int")
    out, drawn = plain_resample(rows, target)
    got = importance.resample(frame, wanted).collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(key(r[:4]) for r in got) == sorted(map(key, out))
    ranked = sorted((r["rank"], *r[:4]) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranked] == drawn


def test_resample_of_little(spark):
    frame = spark.createDataFrame([(1, "one two"), (2, "word " * 25)], "doc_id long, text string")
    nothing = frame.where("doc_id > 9")
    assert importance.resample(nothing, nothing.select("text")).count() == 0
    assert all(r["rank"] is None for r in importance.resample(frame, nothing.select("text")).collect())


def test_first_k_cuts_where_sorting_does(spark):
    rng = np.random.default_rng(1)
    rows = [(int(a), int(b), i) for i, (a, b) in enumerate(zip(rng.integers(-9, 9, 500) ** 5, rng.integers(-3, 3, 500), strict=True))]
    frame = spark.createDataFrame(rows, "a long, b long, c long").cache()
    for k in (0, 1, 137, 499, 500, 600):
        cut = importance.first_k(frame, [F.col("a"), -F.col("b"), F.col("c")], k, ways=3)
        assert sorted(r["c"] for r in frame.where(cut).collect()) == sorted(x[2] for x in sorted(rows, key=lambda x: (x[0], -x[1], x[2]))[:k])
