"""Near-duplicate classes by BagMinHash and banding.

A document is the multiset of its five-word shingles (of all its words, if fewer). A weight is discretised
into unit levels, kept in dyadic intervals [0, 1), [1, 2), [2, 4), ...: each shingle and interval has a Poisson
process of points, each with a time, a component of the signature and a level, drawn from a hash of shingle
and interval. A point counts for a document whose weight is above its level, and the earliest time of each
component is the signature: two documents agree in a component with a probability of their weighted Jaccard
similarity. Points beyond a time at which all components are filled are never made, so a document costs a
hash a shingle and a fixed number of points, whatever its weights.

Sixteen bands of four components give candidates; a pair of similarity 0.8 meets with a probability of 0.9998.
Candidates are verified by the exact overlap of their multisets. Within a band's bucket, all are compared with a
few pivots. After linked documents are joined, the pairs of a bucket that are still apart and have no pivot are found
by a prefix-filtered join, first against a sixteenth of the documents and then, for what is still apart, against
all: most that are linked at all are linked to many, and need only one of them. So groups of copies are never
expanded, and no link within a bucket is left out. Buckets of every size go the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.llm.shared import Scratch, cut, written

WORDS, BANDS, ROWS, SIMILARITY = 5, 16, 4, 0.8
K = BANDS * ROWS
PIVOTS = 4  # of a bucket
SHARES = (16, 1)  # of the documents that a round of the prefix join seeks among: one in 16, then all
HOT_CLASSES = 1000  # classes of more than one in so many rows are at most so many, and broadcast
SMALL_ROWS = 100_000  # of a table that may be broadcast
U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
IN_WORD = np.array([c >= 128 or chr(c).isalnum() or c == 95 for c in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1), modulo 2**64."""
    factors = np.full(n, base, dtype=U)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def spans_hashed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] of each span, from one running sum of a polynomial modulo 2**64."""
    size = 1 << max(10, int(len(values)).bit_length())
    sums = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * powers(BASE, size)[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, size)[starts] + (ends - starts).astype(U))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the text that each stands in (ascending).

    Words are runs of ASCII letters, digits and underscores, and of characters beyond ASCII, in lower case.
    """
    coded = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*coded, b""]), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = IN_WORD[data]
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    words = spans_hashed(data.astype(U) + U(1), starts, ends)
    bounds = np.cumsum([0] + [len(c) + 1 for c in coded])
    from_word = np.searchsorted(starts, bounds)  # the first word of each text
    n = np.diff(from_word)
    owner = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(words))
    stop = np.minimum(at + WORDS, np.repeat(from_word[1:], n))
    keep = (stop - at == WORDS) | (at == np.repeat(from_word[:-1], n))
    return spans_hashed(words, at[keep], stop[keep]), owner[keep]


def bag(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with its weight: values, owners, weights."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return v[at], o[at], np.diff(np.append(at, len(v)))


def signatures(v: np.ndarray, o: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """The (n, K) earliest times; infinite for texts without shingles."""
    sig = np.full(n * K, np.inf)
    weight = np.bincount(o, weights=w, minlength=n)
    todo, spare = weight > 0, 4.0
    while todo.any():
        limit = np.where(todo, (np.log(K) + spare) / np.maximum(weight, 1), 0.0)
        chosen = todo[o]
        ev, eo, ew = v[chosen], o[chosen], w[chosen].astype(np.float64)
        level = 0
        while len(ev):
            low, width = (0.0, 1.0) if level == 0 else (float(2 ** (level - 1)), float(2 ** (level - 1)))
            state = mix(ev + U(level * 0x632BE59BD9B4E019 & (2**64 - 1)))
            doc, most, time, step = eo, ew, np.zeros(len(ev)), 0
            while len(state):
                step += 1
                draw = mix(state + U(step * 0x9E3779B97F4A7C15 & (2**64 - 1)))
                time = time - np.log(((draw >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (K * width)
                live = time <= limit[doc]
                state, doc, most, time, draw = state[live], doc[live], most[live], time[live], draw[live]
                other = mix(draw ^ U(0xA0761D6478BD642F))
                part = ((other >> U(32)) * U(K) >> U(32)).astype(np.int64)
                inside = low + width * (other & U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 < most
                np.minimum.at(sig, doc[inside] * K + part[inside], time[inside])
            level += 1
            more = ew > (1.0 if level == 1 else float(2 ** (level - 1)))
            ev, eo, ew = ev[more], eo[more], ew[more]
        empty = np.isinf(sig.reshape(n, K)).any(axis=1)
        todo &= empty
        sig.reshape(n, K)[todo] = np.inf
        spare += 6.0
    return sig.reshape(n, K)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(n, BANDS) 64-bit keys of the bands."""
    bits = sig.view(U).reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=U) + U(1)), (len(sig), BANDS)).copy()
    for r in range(ROWS):
        key = mix(key * U(0x9E3779B97F4A7C15) + bits[:, :, r])
    return key.view(np.int64)


def fingerprints(v: np.ndarray, o: np.ndarray, w: np.ndarray, n: int) -> list[str | None]:
    """128 bits of each multiset, as hex; equal for equal multisets. None without shingles."""
    parts = []
    for salt in (0x1B873593, 0xCC9E2D51):
        term = mix(mix(v + U(salt)) + w.astype(U))
        total = np.zeros(n, dtype=U)
        np.add.at(total, o, term)
        parts.append(mix(total + U(salt)))
    some = np.bincount(o, minlength=n) > 0
    return [f"{a:016x}{b:016x}" if s else None for a, b, s in zip(*(p.tolist() for p in parts), some.tolist(), strict=True)]


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags of (distinct sorted shingles, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum() + b[1].sum()) - both)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, bands) of (doc_id, text_hash, text): node is the multiset's fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            low = 0
            while low < len(texts):  # some MB of text at a time
                high, size = low, 0
                while high < len(texts) and size < 1_000_000:
                    size += len(texts[high])
                    high += 1
                v, o, w = bag(*shingles(texts[low:high]))
                keys = band_keys(signatures(v, o, w, high - low))
                part = batch.slice(low, high - low)
                bands = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), BANDS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fingerprints(v, o, w, high - low), pa.string()), bands], ["doc_id", "text_hash", "node", "bands"])
                low = high

    return docs.mapInArrow(run, "doc_id long, text_hash long, node string, bands array<long>")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes with the exact similarity of their multisets."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "text_a", "b", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}

        def bag_of(node: str, text: str) -> tuple[np.ndarray, np.ndarray]:
            if node not in memo:
                if len(memo) >= 64:
                    memo.clear()
                v, _, w = bag(*shingles([text]))
                memo[node] = v, w
            return memo[node]

        for batch in batches:
            a, ta, b, tb = (c.to_pylist() for c in batch.columns)
            found = [overlap(bag_of(*x), bag_of(*y)) for x, y in zip(zip(a, ta, strict=True), zip(b, tb, strict=True), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.float64())], ["a", "b", "similarity"])

    return both.mapInArrow(run, "a string, b string, similarity double")


def weighted_shingles(texts: DataFrame) -> DataFrame:
    """(node, shingle, weight) of the distinct shingles of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, low = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), 0
            while low < batch.num_rows:  # some hundred kB of text at a time: the arrays of a text take a multiple of it
                high = low + max(1, int(np.searchsorted(sizes[low:].cumsum(), 500_000)))
                part = batch.slice(low, high - low)
                v, o, w = bag(*shingles(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(o)), pa.array(v.view(np.int64)), pa.array(w.astype(np.int64))], ["node", "shingle", "weight"])
                low = high

    return texts.select("node", "text").mapInArrow(run, "node string, shingle long, weight long")


def prefixes(texts: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """(shingle, node, before, total) of the shingles that a similar document may have as its first in common.

    Shingles are ordered from rare to frequent, alike in every document. Of two similar documents the first
    shingle in common has little weight before it in either: all that comes before isn't shared. before is that
    weight, total the document's. Shingles of one document are left out.
    """
    rows = scratch.written(weighted_shingles(texts), "shingles")
    often = scratch.written(rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "often")
    ordered = rows.join(often, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    own = W.partitionBy("node")
    before = F.sum("weight").over(own.orderBy("n", "shingle").rowsBetween(W.unboundedPreceding, -1))
    ordered = ordered.withColumn("before", F.coalesce(before, F.lit(0))).withColumn("total", F.sum("weight").over(own))
    kept = ordered.where((F.col("n") > 1) & (F.col("before") <= (1 - similarity + 1e-9) * F.col("total")))
    return scratch.written(kept.select("shingle", "node", "before", "total"), "prefixes")


def prefix_pairs(prefix: DataFrame, nodes: DataFrame, similarity: float, share: int) -> DataFrame:
    """(a, b) of the pairs of nodes (node, label, seeks) of different labels that can be so similar: one that seeks, and one in `share`.

    What the two can have in common is at most what is left from the shared shingle on, in either.
    """
    rows = prefix.join(nodes, "node")
    among = F.pmod(F.xxhash64("node", F.lit(share)), F.lit(share)) == 0
    x = rows.where("seeks").select("shingle", among.alias("x_among"), *(F.col(c).alias(f"x_{c}") for c in ("node", "label", "before", "total")))
    y = rows.where(among)
    left = F.least(F.col("total") - F.col("before"), F.col("x_total") - F.col("x_before"))
    needed = similarity / (1 + similarity) * (F.col("total") + F.col("x_total")) - 1e-6
    once = ~F.col("seeks") | ~F.col("x_among") | (F.col("x_node") < F.col("node"))  # a pair that both sides seek is met once
    both = x.join(y, (x["shingle"] == y["shingle"]) & (F.col("label") != F.col("x_label")) & (left >= needed) & once)
    return both.select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b"))


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, label) of every node that is linked: label is the smallest node of its component.

    Alternates large-star and small-star steps until the edges don't change; each is an aggregate and a join,
    so no node's neighbours are gathered. Tables of at most SMALL_ROWS edges, which are counted each round, join by
    broadcast; others by shuffle.
    """
    scratch = scratch or Scratch(links.sparkSession)
    edges = scratch.written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == before or not now[0]:
            break
        before = now
        sized = F.broadcast if now[0] <= SMALL_ROWS else lambda df: df
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(sized(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct() if now[0] <= SMALL_ROWS else cut(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(sized(least), "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v")
        edges = scratch.written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size; see classified."""
    return classified(docs, id_column, text_column, similarity).select("doc_id", "class_id", "class_size")


def still_apart(members: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label, seeks) of the members of buckets with pairs that no pivot has settled: neither is a pivot, and their labels differ.

    seeks: outside the most frequent label of some such bucket.
    """
    rest = members.where("not array_contains(pivots, node)").select("band", "key", "node").join(labels, "node", "left")
    rest = scratch.written(rest.withColumn("label", F.coalesce("label", "node")), "placed")
    sizes = rest.groupBy("band", "key", "label").agg(F.count("*").alias("n"))
    main = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
    main = scratch.written(main.select("band", "key", F.col("main.label").alias("main")), "main")
    apart = rest.join(main, ["band", "key"]).groupBy("node", "label").agg(F.max(F.col("label") != F.col("main")).alias("seeks"))
    return scratch.written(apart, "apart")


def classified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, text_hash, class_id, class_hash, class_size.

    class_id is the smallest id of the documents that a chain of links joins, a link being a weighted Jaccard
    similarity of 0.8 or more over five-word shingles. A null, empty or wordless text is in no class but its own, and
    so is a row with a null id (class_id null). Rows that repeat an id are taken each by its own text; other
    columns are not read; an empty table gives no rows. class_hash is the least text_hash under class_id in the class,
    null for a row in no class. A very long text is one document like any other: its signature takes a fixed number
    of points, and a task holds some MB of text and the shingles of one text beyond that.
    """
    scratch = Scratch(docs.sparkSession)
    written = scratch.written
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    known = written(signed(rows), "signatures")
    nodes = known.where("node is not null and doc_id is not null").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash", "bands")).alias("first"))
    nodes = written(nodes.select("node", "first.doc_id", "first.text_hash", "first.bands"), "nodes")
    spread = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    # small sides are written: a join whose two sides are plain exchanges is split where a key is hot
    part = F.pmod(F.xxhash64("node"), F.lit(PIVOTS))
    buckets = spread.groupBy("band", "key", part.alias("part")).agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node"), "node")).alias("pivot"))
    buckets = buckets.groupBy("band", "key").agg(F.sum("n").alias("size"), F.collect_list("pivot.node").alias("pivots")).where("size > 1")
    buckets = written(buckets.select("band", "key", "pivots"), "buckets")
    members = written(spread.join(buckets, ["band", "key"]), "members")
    involved = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "text_hash")
    texts = written(rows.join(involved, ["doc_id", "text_hash"]).select("node", "text").dropDuplicates(["node"]), "texts")

    by_pivot = members.select("node", F.explode("pivots").alias("other")).where("node <> other")
    by_pivot = by_pivot.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    done = written(compared(written(by_pivot, "pairs"), texts), "compared")
    links = done.where(F.col("similarity") >= similarity).select("a", "b")
    labels = components(links, scratch)

    apart = still_apart(members, labels, scratch)
    if not apart.isEmpty():
        prefix = prefixes(texts.join(apart.select("node"), "node", "left_semi"), similarity, scratch)
        for share in SHARES:
            found = prefix_pairs(prefix, apart, similarity, share).distinct().join(done.select("a", "b"), ["a", "b"], "left_anti")
            more = written(compared(written(found, "pairs"), texts), "compared")
            done, links = done.unionByName(more), more.where(F.col("similarity") >= similarity).select("a", "b")
            # a component found so far is a star of its label
            labels = components(links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))), scratch)
            apart = still_apart(members, labels, scratch)
    named = known.select("doc_id", "text_hash", "node").join(labels, "node", "left").select("doc_id", "text_hash", F.when(F.col("node").isNotNull() & F.col("doc_id").isNotNull(), F.coalesce("label", "node")).alias("label"))
    named = written(named, "named", keep=True)
    classes = named.where("label is not null").groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("class_size"))
    classes = written(classes, "classes", keep=True)
    scratch.drop()
    rows_in_all = named.count()
    hot = F.broadcast(classes.where(F.col("class_size") * HOT_CLASSES > rows_in_all))
    usual = named.join(hot.select("label"), "label", "left_anti").join(classes.where(F.col("class_size") * HOT_CLASSES <= rows_in_all), "label", "left")
    found = usual.unionByName(named.join(hot, "label"))
    return found.select("doc_id", "text_hash", F.coalesce("first.doc_id", "doc_id").alias("class_id"), F.col("first.text_hash").alias("class_hash"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of documents with one of each class, that of the least id and text hash; all columns.

    Rows are told apart by id and text; of rows alike in both one stays, whatever their other columns, and a null text
    is an empty one. Rows in no class all stay. Column names may be any: a row goes through as one struct.
    """
    found = classified(docs).where("class_hash is not null")
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))
    gone = found.where(~first).select("doc_id", "text_hash").distinct()
    key = ["doc_id", "text_hash"]
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    rows = rows.join(gone, key, "left_anti")
    again = written(found.where(first).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), "again")
    if not again.isEmpty():
        rows = rows.join(again, key, "left_anti").unionByName(rows.join(again, key, "left_semi").dropDuplicates(key))
    return rows.select("row.*")
