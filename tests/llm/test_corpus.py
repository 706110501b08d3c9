"""Corpus operators against brute force, round trips and the edge cases of their docstrings."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronoloom.llm import bpe, html, licenses, media, mixing, quality, rans, sharding, simhash, warc
from chronoloom.llm.common import new_path, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    (1, "The quick brown fox's den, twice: the quick brown fox jumps over 123 dogs.", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, "héllo wörld  日本語 tabs\tand\n\nlines " * 40, "b"),
    (4, "héllo wörld  日本語 tabs\tand\n\nlines " * 40, "b"),
    (5, "x" * 5000 + " 1 2 3 4 5 6 7 8 9" * 300, "b"),
    (6, "Released under the MIT License. " + "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3, "c"),
    (7, "The quick brown fox's den, twice: the quick brown fox jumps over 123 dogs!", "a"),
    (None, "no id here but words enough to be kept by every rule of the cascade", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns whose names clash with results.
    return spark.createDataFrame([(*row, "extra", 1) for row in TEXTS], "doc_id long, text string, source string, kept string, n_tokens int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id > 1000")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_bpe_agrees_with_the_library(docs, empty, ranks):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    # A small table sends some words through the fold and the others through the tail.
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, hot_words=5)
    got = sorted((r["doc_id"] or 0, list(r["token_ids"])) for r in encoded.collect())
    assert got == sorted((i or 0, encoding.encode_ordinary(t or "")) for i, t, _ in TEXTS)
    back = sorted((r["doc_id"] or 0, bytes(r["decoded"])) for r in bpe.decode(encoded, ranks).collect())
    assert back == sorted((i or 0, (t or "").encode()) for i, t, _ in TEXTS)
    assert bpe.round_trip(empty, ranks, public_tokenizers.PATTERN).count() == 0


def test_fold_and_heap_merge_alike(spark, ranks):
    rng = np.random.default_rng(3)
    found = ["".join(rng.choice(list("etaoinshr ñé日"), size=n)) for n in rng.integers(1, 24, 60)]
    frame = spark.createDataFrame([(w,) for w in found], "w string")
    folded = frame.select("w", bpe.let(bpe.rank_map(ranks), lambda b: bpe.fold_word(F.col("w"), b)).alias("ids")).collect()
    for row in folded:
        assert list(row["ids"]) == bpe.merge_word(row["w"].encode(), ranks)


def test_mix_meets_targets_and_reruns_agree(spark, empty):
    rng = np.random.default_rng(5)
    rows = [(i, str(rng.choice(["s1", "s2", "s3", "s4"])) if i % 9 else None, int(rng.integers(0, 900))) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    one, two = (mixing.mix(frame).orderBy("doc_id").collect() for _ in range(2))
    assert [tuple(r) for r in one] == [tuple(r) for r in two]
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in one:
        assert 0 <= r["taken_0"] <= r["size"] and 0 <= r["taken_1"] <= r["size"]
        taken[r["source"]] += r["taken_0"] + r["taken_1"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    order = sorted((s for s in size if s is not None)) + [None]
    left, open_, want, weights = 1.5 * sum(size.values()), list(order), {}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if level * weights[s] > 2 * size[s]]
        for s in over or open_:
            want[s] = 2.0 * size[s] if over else level * weights[s]
        left -= sum(want[s] for s in over)
        open_ = [s for s in open_ if s not in want]
    for s in order:
        assert abs(target[s] - want[s]) < 1e-6 and 0 <= target[s] - taken[s] < 1
    assert mixing.mix(empty.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))).count() == 0


@pytest.mark.parametrize("group", [64, 2])
def test_splitting_tree_keeps_totals(spark, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP", group)
    whole = {0: 300, 1: 0, 2: 7, 3: 150, 9: 43}
    rows = mixing.split_quotas(spark.createDataFrame(list(whole.items()), "rank long, n long"), 3, 7).collect()
    by_rank, by_shard = collections.Counter(), collections.Counter()
    for r in rows:
        by_rank[r["rank"]] += r["n"]
        by_shard[r["shard"]] += r["n"]
    assert by_rank == {k: n for k, n in whole.items() if n} and set(by_shard) == set(range(8)) and set(by_shard.values()) <= {62, 63}
    first = [r["n"] for r in rows if r["rank"] == 0]
    assert max(first) < 55 and min(first) > 20  # about 37.5 each


def test_mix_keeps_clashing_columns_and_shuffles_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 50)
    monkeypatch.setattr(mixing, "BLOCKS_PER_SHARD", 4)
    rows = [(i, None if i % 5 == 0 else f"s{i % 3}", 10 + i % 7, i, f"b{i}", -i, "t", True) for i in range(300)] + [(7, "s1", 17, 7, "b7", -7, "t", True)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long, rank int, block string, before int, target string, partly boolean")
    mixed = mixing.mix(frame)
    assert mixed.columns == ["doc_id", "source", "size", "rank", "block", "before", "partly", *mixing.MADE]
    got = mixing.with_places(mixed).collect()
    assert len(got) == len(rows) and all(r["rank"] == r["doc_id"] and r["block"] == f"b{r['doc_id']}" and r["before"] == -r["doc_id"] for r in got)
    for e in (0, 1):
        places = collections.defaultdict(list)
        for r in got:
            assert (r[f"shard_{e}"] is None) == (r[f"place_{e}"] is None) == (not r[f"taken_{e}"])
            if r[f"place_{e}"]:
                places[r[f"shard_{e}"]].append((r[f"place_{e}"], r["doc_id"]))
        assert all(sorted(p for p, _ in x) == list(range(1, len(x) + 1)) for x in places.values())
        assert any([d for _, d in sorted(x)] != sorted(d for _, d in x) for x in places.values())
    flat = mixing.in_shards(mixed, ["doc_id", "rank"]).collect()
    assert sum(r["taken"] for r in flat) == sum(r["taken_0"] + r["taken_1"] for r in got)
    shards = [r["shard"] for r in flat]
    assert len({k for k, g in __import__("itertools").groupby(shards)}) == len([k for k, g in __import__("itertools").groupby(shards)])


def test_html_keeps_the_article_only():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='cookie-notice'>We use the cookies of this and that.</div>"
        "<aside>Sidebar of the day</aside><article><h1>The  head &amp; line</h1><p>A <b>bold</b>ly set text of the day.<br>Next<p>Second &lt;paragraph&gt;.</p>"
        "<section class='comments'><p>I was the first of the readers here.</p></section><script>var x='</p>';</script></article><footer>&copy; me</footer>"
    )
    assert html.main_text(page) == "The head & line A boldly set text of the day. Next Second <paragraph>."
    long = "The fox and the dog are in the house of the man who was there with us. " * 4
    plain = f"<body><div>Menu</div><p>{long}</p><p>Short one.</p><p>{long}</p><p><a href=x>All the linked words of it</a></p></body>"
    assert html.main_text(plain) == f"{long.strip()} Short one. {long.strip()}"
    assert html.main_text(None) == html.main_text("") == html.main_text("<p") == ""


def test_html_of_a_table(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>x y</article>"), (2, None, None)], "page_id long, url string, html string")
    assert sorted(tuple(r) for r in html.extract(pages).collect()) == [(1, "u", "x y", 3), (2, None, "", 0)]
    assert html.extract(pages.where("page_id > 9")).count() == 0


def test_warc_round_trip(spark):
    rows = [(3, "http://b.example.com/x?q=1#f", "<p>é</p>"), (1, "http://a.example.com/x", "same"), (2, "http://a.example.com/x", "same"), (9, None, "same"), (5, "http://c.org", None), (6, "http://c.org", ""), (7, "::bad", "x" * 9999)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    written = warc.write(pages)
    index = warc.build_index(written, least_lines=2)
    got = {r["page_id"]: r for r in warc.fetch(warc.locate(index, written.select("key"))).collect()}
    assert len(got) == len(rows)
    for i, _, body in rows:
        payload = (body or "").encode()
        first = min(j for j, _, b in rows if (b or "") == (body or ""))
        assert got[i]["payload_bytes"] == len(payload) and got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("response", None) if first == i else ("revisit", first))
    one = warc.locate(index, written.where("page_id = 7").select("key").unionByName(spark.createDataFrame([("zz) none",)], "key string")))
    assert [r["page_id"] for r in warc.fetch(one).collect()] == [7]
    assert warc.reversed_host_key("https://user@News.Example.com:8080/a/b?c#d") == "com,example,news)/a/b?c"
    nothing = warc.write(pages.where("page_id > 99"))
    assert warc.fetch(warc.locate(warc.build_index(nothing), nothing.select("key"))).count() == 0


def _fingerprint(text):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_groups(docs, empty, spark):
    got = simhash.groups(docs).collect()
    assert sorted(r["fp"] & (2**64 - 1) for r in got) == sorted(_fingerprint(t) for _, t, _ in TEXTS)
    groups = {r["doc_id"]: r["component_id"] for r in got}
    assert groups[2] == groups[3] == 2 and groups[4] == 4
    assert simhash.groups(empty).count() == 0
    kept = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
    assert len(kept) == len(set(groups.values())) and kept.count(4) == 1


@pytest.mark.parametrize("chunk", [8, 16_384])
def test_links_against_all_pairs(spark, chunk):
    rng = np.random.default_rng(11)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = sorted({int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 7), replace=False)) for b in base for _ in range(30)})
    nodes = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "rep long, fp long")
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    got = {r["node"]: r["component"] for r in simhash.connected(simhash.links(nodes, chunk)).collect()}
    assert [got.get(i, i) for i in range(len(fps))] == label


def _picture_hash(payload):
    """Cosine sums one by one."""
    rows = [payload[i : i + 192] for i in range(0, len(payload), 192)]
    grey = np.array([[float(sum(r[3 * x : 3 * x + 3])) for x in range(64)] for r in rows])
    for axis in (0, 1):
        n = grey.shape[axis]
        edges = [k * n // 32 for k in range(33)]
        cells = [grey.take(range(a, b), axis).mean(axis) if n >= 32 else grey.take(a, axis) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        grey = np.stack(cells, axis)
    low = [round(sum(grey[y, x] * np.cos(np.pi * (2 * y + 1) * u / 64) * np.cos(np.pi * (2 * x + 1) * v / 64) for y in range(32) for x in range(32)), 6) for u in range(8) for v in range(8)]
    middle = np.median(low[1:])
    return int("".join("1" if x > middle else "0" for x in low), 2).to_bytes(8).hex()


def test_media_round_trip(docs, empty):
    rows = media.features(media.store(docs)).collect()
    payloads = [media.padded((text or "").encode()) for _, text, _ in TEXTS]
    stored = [media.encode_png(p) for p in payloads]
    expected = sorted((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(m), hashlib.sha256(m).hexdigest(), _picture_hash(p)) for p, m in zip(payloads, stored, strict=True))
    assert sorted((r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"], r["media_sha256"], r["feature"]) for r in rows) == expected
    assert len({tuple(r) for r in rows if r["doc_id"] == 4}) == 1
    assert media.features(media.store(empty)).count() == 0
    png = bytearray(media.encode_png(bytes(range(192)) * 3))
    png[60] ^= 1
    with pytest.raises((ValueError, zlib.error)):
        media.decode_png(bytes(png))


def test_every_row_filter_is_undone():
    rng = np.random.default_rng(1)
    rows, step = rng.integers(0, 256, (10, 12), dtype=np.uint8), 3
    raw, above = [], np.zeros(12, int)
    for i, row in enumerate(rows.astype(int)):
        left, corner = np.concatenate([np.zeros(step, int), row[:-step]]), np.concatenate([np.zeros(step, int), above[:-step]])
        p = left + above - corner
        a, b, c = abs(p - left), abs(p - above), abs(p - corner)
        paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))
        guess = [0 * row, left, above, (left + above) // 2, paeth][i % 5]
        raw.append(np.concatenate([[i % 5], (row - guess) % 256]))
        above = row
    assert (media.unfiltered(np.array(raw, np.uint8), step) == rows).all()


def test_quality_counts(docs, empty):
    got = sorted(quality.judge(docs, order=list(quality.rules())).collect(), key=lambda r: (r["doc_id"] or 0))
    for r, (_, text, _) in zip(got, sorted(TEXTS, key=lambda x: x[0] or 0), strict=True):
        found = WORD.findall(text or "")
        counts = collections.Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
        covered = {k for i in range(len(found) - 4) if counts[tuple(found[i : i + 5])] > 1 for k in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(found), sum(map(len, found)), len(lines) - len(set(lines)), len(covered))
        failed, n, letters = len(found) < 10 or 100 * len(covered) > 20 * len(found), len(found), [c for c in text or "" if c.isalpha()]
        symbols, shouted, worded = len(re.findall(r"[#*$%&|<>]", text or "")), sum(c.isupper() for c in letters), sum(any(c.isalpha() for c in w) for w in found)
        fine = 2 * n <= sum(map(len, found)) <= 12 * n and 10 * symbols <= n and 2 * r["n_dup_lines"] <= len(lines) and 2 * shouted <= len(letters) and 2 * worded >= n
        assert (r["n_symbols"], r["base_failed"], r["kept"]) == (symbols, failed, not failed and fine)
    assert quality.judge(empty).count() == 0
    assert sorted(quality.cascade_order(docs.select("text"), quality.rules(), quality.base_counts)) == sorted(quality.rules())


def test_token_files_round_trip(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    # Long blocks have checkpoints inside; a session that has seen nothing but the folder reads them.
    folder = rans.write(docs, path, 2, 49_408, block_tokens=50, check_tokens=1024)
    assert docs.sparkSession.read.parquet(f"{folder}/files").count() > 0
    got = sorted(rans.read(docs.sparkSession.newSession(), folder, check_tokens=1024).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 4, 5, 6, 7]
    texts, start = {i: t for i, t, _ in TEXTS}, 0
    for r in got:
        ids = [*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert rans.read(docs.sparkSession, rans.write(empty, path, 2, 49_408)).count() == 0
    with pytest.raises(TypeError, match="integers"):
        rans.write(docs.withColumn("doc_id", F.lit("x")), path, 2, 49_408)


def test_rans_blocks():
    rng = np.random.default_rng(2)
    for n in (1, 5, 1024, 5000):
        ids = np.minimum(rng.geometric(0.01, n), 999).astype(np.uint32)
        freq = rans.frequencies(np.bincount(ids, minlength=1000))
        assert freq.sum() == 1 << rans.SCALE
        symbols = np.repeat(np.arange(1000, dtype=np.uint32), freq)
        payload, marks = rans.encode_block(ids, freq, every=2048)
        assert (rans.decode_block(payload, n, freq, symbols) == ids).all() and len(marks) == (n - 1) // 2048 * (4 + 8 * rans.LANES)
        for low, high in ((0, n), (2048, 3000), (2100, 4100), (4095, 5000)):
            if high <= n:
                assert (rans.decode_block(payload, n, freq, symbols, marks, low, high, 2048) == ids[low:high]).all()


def test_shards_keep_rows_and_versions(spark, docs):
    root = new_path(spark, "test-shards")
    many = docs.select("doc_id", "text", F.lit("own").alias("_arrival"), F.explode(F.sequence(F.lit(0), F.lit(40))).alias("n"))
    many = many.withColumn("batch", F.when(F.col("n") % 3 > 0, F.col("n") % 3 - 2))  # arrivals null, -1 and 0
    assert sharding.append(spark, many.where("n < 0"), root, "batch") == 1
    assert sharding.read(spark, root).count() == 0 and sharding.read(spark, root).columns == ["doc_id", "text", "_arrival", "n", "_shard", "_row"]
    assert sharding.append(spark, many.repartition(6), root, "batch") == 2
    assert sharding.append(spark, many.where("n = 0"), root, "batch") == 3
    assert {r["arrival"] for r in sharding.manifest(spark, root).collect()} == {None, -1, 0}
    before, old = sharding.manifest(spark, root).count(), sharding.read(spark, root)
    last = sharding.compact(spark, root)
    assert last > 3 and sharding.manifest(spark, root).count() < before
    count = lambda d: collections.Counter((r["doc_id"], r["text"], r["_arrival"], r["n"]) for r in d.collect())
    whole = count(many) + count(many.where("n = 0"))
    # A frame that was made before the merge, and the version itself, still hold.
    assert count(old) == count(sharding.read(spark, root, 3)) == count(sharding.read(spark, root)) == whole
    with pytest.raises(Exception, match="(?i)exist"):
        sharding.commit(sharding.manifest(spark, root), root, last - 1)
    assert sharding.expire(spark, root, last) > 0 and sharding.versions(spark, root) == [last] and count(sharding.read(spark, root)) == whole
    with pytest.raises(ValueError, match="name others"):
        sharding.read(spark, root, shard_col="n")


def test_merge_groups_by_tier(spark):
    sizes = [(10, 1), (12, 2), (900, 3), (70, 4), (11, 5), (300, 6), (400, 7), (350, 8)]
    shards = spark.createDataFrame([(str(k), size, 1, 0, k) for size, k in sizes], sharding.MANIFEST)
    assert sorted(r["paths"] for r in sharding.merge_groups(shards, target=1000, fan_in=8).collect()) == [["1", "2", "5"], ["6", "7"]]


def test_license_scan(docs, empty, spark):
    assert {(r["doc_id"], r["license"], r["containment"]) for r in licenses.scan(docs).collect()} == {(6, "MIT", 1.0)}
    assert licenses.scan(empty).count() == 0
    body = "filler word here " * 50 + "This work is licensed under the GNU General Public License, version 3. " + "more filler words " * 50
    found = licenses.scan(spark.createDataFrame([(1, body), (2, "This work is licensed under something else entirely, version 3")], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["license"], r["containment"]) for r in found] == [(1, "GPL-3.0", 1.0)]


def test_license_bodies_against_all_windows(spark):
    """Every place of every text is held against every template, without bands."""
    from chronoloom.llm import license_texts

    rng = np.random.default_rng(41)
    filler = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 400, n))
    rows = []
    for i, (_, body) in enumerate(license_texts.TEMPLATES):
        words = body.split()
        for at in rng.choice(len(words), len(words) // 60, replace=False):
            words[at] = "changed"
        rows.append((i, f"{filler(int(rng.integers(0, 90)))} {' '.join(words)} {filler(int(rng.integers(0, 400)))}"))
    rows.append((900, filler(3000) + " " + license_texts.MIT + " " + filler(3000)))
    rows.append((901, filler(500)))
    rows.append((902, " ".join(license_texts.MIT.split()[:9])))
    plain = lambda text: re.findall(r"[^\W_]+", text.lower())
    cut = lambda w: [" ".join(w[k : k + 5]) for k in range(len(w) - 4)]
    expected = set()
    for i, text in rows:
        words = plain(text)
        have = cut(words)
        for name, body in license_texts.TEMPLATES:
            wanted, (within, after, never) = set(cut(plain(body))), licenses.clauses(name, body)
            width = len(wanted) + -(-len(wanted) // 2)
            for start in range(0, max(1, len(have)), max(1, len(wanted) // 2)):
                near = f" {' '.join(words[start : start + width + 4])} "
                if len(wanted & set(have[start : start + width])) < 0.8 * len(wanted):
                    continue
                # Later clauses are looked for up to where the notice begins again.
                begins = [k for k in range(start + min(width, len(have) - start), len(words)) if words[k : k + 5] == plain(body)[:5]]
                stop = begins[0] if begins else len(words)
                follows = lambda x, at=start, stop=stop: any(words[k : k + len(x.split())] == x.split() for k in range(at, stop))
                if all(f" {x} " in near for x in within) and all(map(follows, after)) and not any(map(follows, never)):
                    expected.add((i, name))
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected and {i for i, _ in got} >= set(range(len(license_texts.TEMPLATES))) - {4, 5, 6} and (900, "MIT") in got


def test_joined_pieces_tokenize_alone():
    import public_tokenizers
    import tokenizers

    from chronoloom.llm import rans

    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = ["a", "<", "<|endoftext|", "<|endoftext|>x", "it's", "é", "́b", "|>", "<|startoftext|>", "", "ÀB1,2", " ", "<|endoftext|>"] * 30
    assert list(rans.tokenized(tokenizer, pieces)) == [tokenizer.encode(p, add_special_tokens=False).ids for p in pieces]
    clean = [f"w{i}-{i * i}" for i in range(1000)]
    assert list(rans.tokenized(tokenizer, clean)) == [tokenizer.encode(p, add_special_tokens=False).ids for p in clean]


def test_words_and_tails_tokenize_alone():
    import random

    import public_tokenizers
    import pyarrow as pa

    from chronoloom.llm import rans

    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        tokenizer, by_word = rans.load_tokenizer(file.read())
    assert by_word
    draw = random.Random(3)
    odd = [*"abZÉßœİıΣς,.'\"()-_01 中あ한ª", "'s", "'ll", "́", "J̌", "<|endoftext|>", "</w>", "\xad", "\xa0", "🙂"]
    pieces = ["", "a", "A,", "<|endoftext|>", *("".join(draw.choices(odd, k=draw.randint(1, 6))).replace(" ", "") for _ in range(3000))]
    pieces += ["".join(draw.choices(rans.LETTERS, k=draw.randint(1, 9))) + "".join(draw.choices(rans.PUNCTUATION, k=draw.randint(0, 4))) for _ in range(3000)]
    want = [tokenizer.encode(x, add_special_tokens=False).ids for x in pieces]
    for form in (by_word, None):
        pool, length = rans.piece_ids(tokenizer, form, pa.array(pieces))
        assert [x.tolist() for x in np.split(pool, np.cumsum(length)[:-1])] == want
    none = rans.piece_ids(tokenizer, by_word, pa.array([], pa.string()))
    assert not len(none[0]) and not len(none[1])


@pytest.mark.parametrize(("chunk", "first"), [(4096, 2), (8, 1)])
def test_near_copies_against_all_pairs(spark, chunk, first):
    from functools import partial

    from chronoloom.llm import jaccard

    rng = np.random.default_rng(17)
    texts: list[str | None] = [None, "", "two words", "Two  WORDS"]
    for _ in range(8):
        base = [f"w{x}" for x in rng.integers(0, 5000, 100)]
        for _ in range(12):
            changed = list(base)
            for at in rng.choice(100, rng.integers(0, 4), replace=False):
                changed[at] = f"x{rng.integers(0, 10**6)}"
            texts.append(" ".join(changed))
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if (5 * len(sets[i] & sets[j]) >= 4 * union) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = simhash.keep_one(frame, find=partial(jaccard.groups, chunk=chunk, first=first)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(label))
    assert jaccard.groups(frame.where("doc_id > 10000")).count() == 0


def test_pipeline_drops_near_copies_of_similarity_080(spark):
    import corpus_pipeline

    base = [f"word{i}" for i in range(100)]
    near = [*base[:30], "other", *base[31:70], "another", *base[71:]]
    rows = [(1, " ".join(base), "en", "a", 0), (2, " ".join(near), "en", "a", 0), (3, " ".join(reversed(base)), "en", "a", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near_dedup = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r["doc_id"] for r in near_dedup(spark, frame, "").collect()) == [1, 3]


LONG_PROSE = "The fox and the dog are in the house of the man who was there with us. " * 4


@pytest.mark.parametrize(
    "start",
    ["<div class='content has-sidebar'>", "<div class='post has-comments'>", "<div class='layout no-sidebar'><article>", "<div class='sidebar-layout'><article>", "<div class='social-story'>"],
)
def test_html_names_do_not_reject_the_main_text(start):
    assert html.main_text(f"<body><nav>Menu</nav>{start}<p>{LONG_PROSE}</p></body>") == LONG_PROSE.strip()


def test_html_keeps_headers_of_articles_and_ends_open_heads():
    page = f"<article><header class='entry-header'><h1>The headline</h1></header><p>{LONG_PROSE}</p></article><section id='comments'><p>{LONG_PROSE * 3}</p></section>"
    assert html.main_text(page) == f"The headline {LONG_PROSE.strip()}"
    assert html.main_text(f"<html><head><title>t</title><meta charset=utf-8><body><p>{LONG_PROSE}</p>") == LONG_PROSE.strip()
    assert html.main_text(f"<html><head><script>x</script><p>{LONG_PROSE}</p>") == LONG_PROSE.strip()


def test_html_in_a_language_without_known_stop_words():
    prose = "Быстрая рыжая лисица перепрыгнула через ленивую собаку возле старого дома. " * 5
    assert html.main_text(f"<body><div><a href=x>Главная</a></div><p>{prose}</p><p>Коротко.</p><p>{prose}</p></body>") == f"{prose.strip()} Коротко. {prose.strip()}"


def test_licenses_are_told_apart(spark):
    program = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. keep this. "
    holders = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS"
    cases = [
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
        *[(program.format(n, v), {k}) for n, v, k in (("General Public License", "2", "GPL-2.0"), ("General Public License", "3", "GPL-3.0"), ("Lesser General Public License", "2.1", "LGPL-2.1"), ("Affero General Public License", "3", "AGPL-3.0"))],
        ("Licensed under CC BY 4.0.", {"CC-BY-4.0"}),
        ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
        ("Licensed under the MIT License.", {"MIT"}),
        (bsd + holders, {"BSD-2-Clause"}),
        (bsd + "Neither the name of the holder may be used. " + holders, {"BSD-3-Clause"}),
        # However far the clause is; another notice's clause does not count.
        (bsd + "much more to say " * 500 + "Neither the name of the holder may be used. " + holders, {"BSD-3-Clause"}),
        (bsd + holders + " and so on " * 90 + bsd + "Neither the name of the holder may be used. " + holders, {"BSD-2-Clause", "BSD-3-Clause"}),
        ("distributed under the MIT license", {"MIT"}),
        ("MIT License Copyright (c) 2020 Somebody", {"MIT"}),
        ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", {"CC-BY-3.0"}),
        ("SPDX-License-Identifier: Apache-2.0", {"Apache-2.0"}),
        ("SPDX-License-Identifier: GPL-3.0-only", {"GPL-3.0"}),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", {"LGPL-2.1"}),
        ("CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", {"CC0-1.0"}),
    ]
    frame = spark.createDataFrame([(i, "filler words come first here " + t + " and more after it") for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = collections.defaultdict(set)
    for r in licenses.scan(frame).collect():
        got[r["doc_id"]].add(r["license"])
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]
