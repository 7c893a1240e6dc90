import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from formloom.llm import exact_dedup, near_dedup, suffix_dedup
from formloom.llm.shared import Scratch


def docs_of(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumn("key", F.lit(1)).withColumn("n", F.lit("x")).withColumn("bucket", F.lit(0)) if extra else df


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "x" * 100_000), (7, "x" * 100_000), (3, "a"), (None, "b"), (None, "q"), (8, "é\n")]


def test_exact(spark):
    for bits, capacity in ((64, 100_000), (1, 1), (2, 2)):  # few bits: several texts a key
        got = exact_dedup.exact_dedup(docs_of(spark, ROWS), hash_bits=bits, bucket_capacity=capacity).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == brute_exact(ROWS)
        if bits == 1:
            assert max(r.chain for r in got) > 1
    assert exact_dedup.exact_dedup(docs_of(spark, ROWS).limit(0)).count() == 0


def test_directory(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    slots, depth = exact_dedup.directory(keys, 100)
    rows = slots.collect()
    assert len(rows) == 1 << depth and depth >= 5
    held = Counter(r[0] for r in keys.select(exact_dedup.slot_of(F.col("key"), depth)).collect())
    size = Counter()
    for r in rows:
        assert r.bucket == r.slot >> (depth - r.local_depth) << (depth - r.local_depth)
        size[r.bucket] += held[r.slot]
    assert sum(size.values()) == 4000 and max(size.values()) <= 100


def test_directory_deepens_where_cells_are_overfull(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    few, many = exact_dedup.directory(keys, 30, cell_bits=2), exact_dedup.directory(keys, 30)
    assert few[1] == many[1] > 6 and sorted(few[0].collect()) == sorted(many[0].collect())
    assert exact_dedup.directory(keys.limit(0), 30)[1] == 0


def test_index(spark, tmp_path):
    docs = docs_of(spark, ROWS, extra=False).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    index, _, _ = exact_dedup.build_index(docs, f"file://{tmp_path}/index", Scratch(spark), 1, 1)
    entries = index.collect()
    groups = Counter(t or "" for _, t in ROWS)
    assert sorted((r.text, r.group_size) for r in entries) == sorted(groups.items())  # of two keys, so all chains have several links
    assert all(sorted(r.chain for r in entries if r.key == k) == list(range(1, n + 1)) for k, n in Counter(r.key for r in entries).items())


def test_keep_distinct(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (4, None), (4, ""), (6, "c"), (None, "c"), (None, "d"), (None, "d")]
    names = ["row", "own_id", "own_text", "kept_doc_id", "kept_sha256", "gone_doc_id", "text_hash", "class_id"]
    docs = docs_of(spark, rows).withColumns({n: F.lit(n) for n in names})
    want = [(2, "a"), (3, "b"), (4, ""), (6, "c"), (None, "d")]
    kept = exact_dedup.keep_distinct(docs)
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == sorted(want, key=str)
    assert kept.columns == near_dedup.keep_one(docs).columns == docs.columns
    assert near_dedup.keep_one(docs.where("doc_id = 4")).count() == 2  # without a word they are in no class
    assert exact_dedup.keep_distinct(docs.limit(0)).count() == near_dedup.keep_one(docs.limit(0)).count() == 0


def test_native_plan(spark):
    plan = exact_dedup.exact_dedup(docs_of(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def shingles(text):
    words = re.findall(r"[a-z0-9_\x80-\U0010ffff]+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(rows, least=0.8):
    bags = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            if a and b and rows[i][0] is not None and rows[j][0] is not None and (a & b).total() >= least * (a | b).total():
                parent[root(i)] = root(j)
    classes = {}
    for k, (i, _) in enumerate(rows):
        classes.setdefault(root(k), []).append(i)
    return sorted(((i, min((c for c in classes[root(k)] if c is not None), default=None) if i is not None else None, len(classes[root(k)])) for k, (i, _) in enumerate(rows)), key=str)


def near_rows():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(40, 120))]
        for _ in range(8):
            text = base[:]
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(500, None), (501, ""), (502, "  !! "), (503, "a b"), (504, "A, b!"), (505, "spam " * 4000), (506, "spam " * 4100), (507, "spam " * 6000), (None, rows[0][1]), (None, "z")]
    return rows


def test_pairs_that_are_apart_are_joined_by_prefixes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PIVOTS", 1)
    rows = near_rows()
    for shares in ((3, 1), (1,)):
        monkeypatch.setattr(near_dedup, "SHARES", shares)
        assert sorted((tuple(r) for r in near_dedup.near_duplicates(docs_of(spark, rows)).collect()), key=str) == brute_classes(rows)


def test_near_duplicates(spark):
    rows = near_rows()
    got = sorted((tuple(r) for r in near_dedup.near_duplicates(docs_of(spark, rows)).collect()), key=str)
    assert got == brute_classes(rows)
    kept = {r.doc_id for r in near_dedup.keep_one(docs_of(spark, rows)).collect()}
    assert kept == {i for i, c, _ in got if i == c}
    assert near_dedup.near_duplicates(docs_of(spark, rows).limit(0)).count() == 0


def test_keep_one_tells_rows_of_one_id_apart(spark):
    rng = random.Random(21)
    text = lambda: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60))
    a, b, c, d = text(), text(), text(), text()
    rows = [(1, a), (2, a + " tail"), (2, b), (3, c), (3, c + " tail"), (4, d), (4, d), (5, None), (5, None), (None, a)]
    got = [(r.doc_id, r.text) for r in near_dedup.keep_one(docs_of(spark, rows)).collect()]
    assert sum(i == 3 for i, _ in got) == 1
    assert sorted((x for x in got if x[0] != 3), key=str) == sorted([(1, a), (2, b), (4, d), (5, None), (5, None), (None, a)], key=str)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(0)
    off = []
    for _ in range(60):
        v = rng.integers(0, 2**63, 150).astype(np.uint64)
        a = rng.integers(0, 6, 150)
        b = np.where(rng.random(150) < 0.7, a, rng.integers(0, 6, 150))
        o = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = near_dedup.signatures(np.concatenate([v[a > 0], v[b > 0]]), o, np.concatenate([a[a > 0], b[b > 0]]), 2)
        off.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.025 and np.std(off) < 0.09


def test_components(spark):
    rng = random.Random(7)
    for edges in ([(f"{k:03}", f"{k + 1:03}") for k in range(60)], [(f"{rng.randrange(80):03}", f"{rng.randrange(80):03}") for _ in range(60)]):
        got = {r.node: r.label for r in near_dedup.components(spark.createDataFrame(edges, "a string, b string")).collect()}
        label = {n: n for e in edges for n in e}
        for _ in range(100):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        assert got == {n: x for n, x in label.items() if any(a != b and n in (a, b) for a, b in edges)}


def brute_repeats(rows, window):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + window] for _, b in texts for p in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if seen[b[p : p + window]] > 1:
                gone[p : p + window] = b"\1" * window
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_repeats(spark):
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcd éx") for _ in range(rng.randint(10, 60))) for _ in range(6)]
    rows = [(i, "".join(rng.choice([*passages, "q", f"zz y{rng.random()}"]) for _ in range(rng.randint(0, 8)))) for i in range(150)]
    rows += [(900, "ab" * 200), (901, "a" * 333), (902, "a" * 39), (903, None), (904, ""), (7, rows[7][1]), (905, "é" * 90), (None, rows[8][1])]
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs_of(spark, rows), window=40, gram=12).collect()), key=str)
    assert got == brute_repeats(rows, 40)
    assert suffix_dedup.remove_repeats(docs_of(spark, rows).limit(0)).count() == 0


def test_hot_anchors_are_parted(spark):
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    shared = noise(33)
    ends = [noise(25) for _ in range(4)]
    rows = [(k, noise(rng.randint(0, 30)) + shared + noise(rng.randint(0, 30))) for k in range(30)]
    rows += [(30 + k, noise(20) + ends[k % 2] + shared + ends[2 + k % 2][: rng.randint(3, 25)] + noise(k % 3)) for k in range(40)]
    rows += [(70 + k, noise(5) + shared + ends[k % 4] + noise(30)) for k in range(20)] + [(5, rows[5][1]), (90, ends[0] + shared)]
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs_of(spark, rows), window=40, gram=12, most=4).collect()), key=str)
    assert got == brute_repeats(rows, 40)
    texts = [t.encode() for _, t in rows]
    contexts = [(1, k, t.index(shared.encode()) + 10, True, suffix_dedup.context(t, t.index(shared.encode()) + 10, 40, 12)) for k, t in enumerate(texts)]
    parts, _ = suffix_dedup.parted(spark.createDataFrame(contexts, "anchor long, row_key long, place int, lone boolean, bytes binary"), 40, 12, 4)
    assert parts.groupBy("part").count().agg(F.max("count")).first()[0] <= 4


def test_long_texts_are_cut_with_an_overlap():
    rng = random.Random(9)
    text = bytes(rng.choice(b"abcdefgh") for _ in range(300_000))
    owner, place, value = suffix_dedup.anchors_of([text, text[150_000:151_000]])
    own = {(p, v) for o, p, v in zip(owner, place, value, strict=True) if o == 0}
    assert all((p + 150_000, v) in own for o, p, v in zip(owner, place, value, strict=True) if o == 1)
    assert all(b - a <= 137 for a, b in zip(sorted(p for p, _ in own), sorted(p for p, _ in own)[1:], strict=False))


def test_column_wise_order():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, (200, 30)).astype(np.uint8)
    got = suffix_dedup.repeated_windows(data, 12)
    for c in range(19):
        seen = Counter(bytes(r[c : c + 12]) for r in data)
        assert [seen[bytes(r[c : c + 12])] > 1 for r in data] == got[:, c].tolist()
