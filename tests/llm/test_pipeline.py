"""The pipeline against brute force: every stage stated again in plain Python."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from chronoloom.llm import bpe, jaccard, pipeline
from chronoloom.llm.common import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def made_documents():
    rng = np.random.default_rng(23)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(2, 9))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    rows = []
    for i in range(50):
        rows.append((i, text(int(rng.integers(12, 160))), "en", ["a", "b", "c", None][i % 4]))
    for i in (3, 8, 13):
        words = rows[i][1].split()
        rows.append((100 + i, rows[i][1].upper(), "en", "b"))
        rows.append((200 + i, " ".join([*words, "one", "more"]), "fr", "a"))
    rows += [(60, None, "en", "a"), (61, "", "en", "b"), (62, "too short", "de", "c"), (63, "same words again " * 30, "en", "a"), (64, "# $ % & | < > # $ % & |", "en", "a")]
    rows += [(65, "HALF SHOUTED WORDS OF SOME LENGTH GO ON AND ON HERE now", "en", "b"), (66, "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "en", "c"), rows[5], (None, text(40), None, None)]
    return [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]


def passes(text):
    found = WORD.findall(text or "")
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    counts = collections.Counter(windows)
    covered = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    letters = [c for c in text or "" if c.isalpha()]
    n = len(found)
    return (
        n >= 10 and 100 * len(covered) <= 20 * n and 2 * n <= sum(map(len, found)) <= 12 * n and 10 * len(re.findall(r"[#*$%&|<>]", text)) <= n
        and 2 * (len(lines) - len(set(lines))) <= len(lines) and 2 * sum(c.isupper() for c in letters) <= len(letters) and 2 * sum(any(c.isalpha() for c in w) for w in found) >= n
    )


def shingles(text):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4)) or frozenset([tuple(found)])


def deduplicated(rows):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    first = {}
    for row, group in sorted(zip(rows, label, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        first.setdefault(group, row)
    return collections.Counter(first.values())


@pytest.fixture(scope="module")
def stages(spark):
    rows = made_documents()
    frame = spark.createDataFrame(rows, COLUMNS)
    out = [rows]
    for place, (name, stage) in enumerate(pipeline.STAGES):
        made = stage(spark, frame, "")
        if place + 1 < len(pipeline.STAGES):
            assert made.columns == frame.columns
            frame = materialize(made, name)
            made = frame
        out.append([tuple(r) for r in made.collect()])
    return out


def test_each_stage_against_brute_force(stages):
    rows, kept, single, mixed, coded = stages
    assert collections.Counter(kept) == collections.Counter(r for r in rows if passes(r[1])) and len(kept) > 45
    assert collections.Counter(single) == deduplicated(kept) and len(single) < len(kept)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in single:
        sizes[r[3]] += len(WORD.findall(r[1]))
    times = collections.Counter(mixed)
    assert set(times) <= set(single) and max(times.values()) <= 2
    for r in mixed:
        taken[r[3]] += len(WORD.findall(r[1]))
    order = sorted(s for s in sizes if s is not None) + [None]
    weights, left, open_, want = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), list(order), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if level * weights[s] > 2 * sizes[s]]
        for s in over or open_:
            want[s] = 2.0 * sizes[s] if over else level * weights[s]
        left -= sum(want[s] for s in over)
        open_ = [s for s in open_ if s not in want]
    longest = max(len(WORD.findall(r[1])) for r in single)
    assert all(want[s] - 2 < taken[s] < want[s] + 2 * longest for s in order)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    expected = collections.Counter()
    for i, text, *_ in mixed:
        ids = encoding.encode_ordinary(text)
        expected[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), tuple(ids)] += 1
    assert collections.Counter((*r[:4], tuple(r[4])) for r in coded) == expected


def test_pipeline_of_an_empty_table(spark):
    frame = spark.createDataFrame([], COLUMNS)
    for name, stage in pipeline.STAGES:
        frame = materialize(stage(spark, frame, ""), name)
        assert frame.count() == 0


def test_near_copies_within_three_bits_are_joined_by_their_fingerprints(spark, monkeypatch):
    """SimHash is a step of its own: with no band that meets, it still joins what it can see, and the exact test still refuses."""
    words = [f"w{i}" for i in range(4000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "end"])), (3, " ".join(reversed(words)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "meetings", lambda nodes, chunk: nodes.limit(0).selectExpr("0 AS band", "0L AS key", "0 AS c", "0 AS d", "node"))
    group = {r["doc_id"]: r["component_id"] for r in jaccard.groups(frame).collect()}
    assert group[1] == group[2] != group[3]
