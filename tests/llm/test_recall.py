"""Recall of the pipeline's near-duplicates on given documents: every pair against every other."""

import itertools
import os

import pytest

from chronoloom.llm import jaccard

FOLDER = os.environ.get("RECALL_SF_DIR", "/root/testdata/sf0.01")


def shingles(text):
    words = (text or "").encode().translate(jaccard._LOWER).split()
    n = jaccard.SHINGLE
    return frozenset(zip(*[words[k:] for k in range(n)], strict=False)) if len(words) > n else frozenset([tuple(words)] if words else [])


@pytest.mark.skipif(not os.path.exists(FOLDER), reason="needs the given tables")
def test_near_copies_meet_in_one_group(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    # Equal sets are one node; all pairs of different ones are compared.
    sets = {}
    for r in rows:
        sets.setdefault(shingles(r["text"]), r["doc_id"])
    by_size = sorted(((len(s), i, s) for s, i in sets.items() if s), key=lambda x: x[:2])
    close = []
    for (n, i, a), (m, j, b) in itertools.combinations(by_size, 2):
        if 5 * n >= 4 * m and 5 * (common := len(a & b)) >= 4 * (n + m - common):
            close.append((i, j))
    group = {r["doc_id"]: r["component_id"] for r in jaccard.groups(docs).collect()}
    found = sum(group[i] == group[j] for i, j in close)
    print(f"{len(close)} pairs of different sets, {found} found")
    assert close and found >= 0.9 * len(close)
    # Equal sets are always one group, and nothing else joins what no chain of close pairs joins.
    label = {r["doc_id"]: sets[shingles(r["text"])] for r in rows}
    parent = {i: i for i in label.values()}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in close:
        parent[top(i)] = top(j)
    homes = {}
    for i, g in group.items():
        assert homes.setdefault(g, top(label[i])) == top(label[i])
