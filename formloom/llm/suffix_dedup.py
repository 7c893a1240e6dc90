"""Removal of repeated byte strings, by anchors and column-wise construction of a multi-document order.

Every window of `window` bytes has one anchor: the k-gram of least hash in it, the last of equals. Equal windows
have equal anchors at equal places, so all occurrences of a repeated window meet in its anchor's group, and each
can be laid into a context that holds every window around the anchor. Contexts are aligned, and their order is
built column by column from the right: each round puts one symbol of every context in front of its suffix, sorts
the suffixes by that symbol (stably, so by symbol and then by the former rank: the positional Burrows-Wheeler
step) and updates the common prefixes of neighbours. Where a common prefix reaches the window's length, the
window is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm.shared import cut, written

WINDOW, GRAM = 200, 64
MOST = 50_000  # contexts of one anchor or part; more are parted
BLOCK = 1 << 17
PAD = 0xFF  # stands in no UTF-8 text
U = np.uint64
BASE = 0xA24BAED4963EE407
INVERSE = pow(BASE, -1, 2**64)


@lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=U)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(29))
    x = x * U(0x9E3779B97F4A7C15)
    return x ^ (x >> U(32))


def running(data: np.ndarray) -> np.ndarray:
    """Running sums of byte * BASE**place, modulo 2**64."""
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, BLOCK + 1024)[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, BLOCK + 1024)[starts] + (ends - starts).astype(U))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) of every i at which it is whole."""
    n = len(x)
    rows = -(-n // w)
    full = np.full(rows * w, np.iinfo(np.uint64).max, dtype=U)
    full[:n] = x
    full = full.reshape(rows, w)
    ahead = np.minimum.accumulate(full, axis=1).reshape(-1)
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def block_anchors(data: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchors of all windows that lie within one of the texts that bounds part. At most BLOCK bytes."""
    if len(data) < window:
        return np.zeros(0, np.int64), np.zeros(0, U)
    sums = running(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hash(sums, at, at + gram)
    ranked = (grams & U(~(BLOCK - 1) & (2**64 - 1))) | (U(BLOCK - 1) - at.astype(U))  # of equals the last is least
    least = sliding_min(ranked, window - gram + 1)
    stop = bounds[np.searchsorted(bounds, np.arange(len(least)), side="right")]
    least = least[np.arange(len(least)) + window <= stop]
    places = np.unique(BLOCK - 1 - (least & U(BLOCK - 1)).astype(np.int64))
    return places, grams[places]


def blocks(texts: list[bytes], window: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Bytes of at most BLOCK, with (text, its offset, its length) of the parts; a longer text is cut with an overlap."""
    held, parts, size = [], [], 0
    for k, text in enumerate(texts):
        for low in range(0, max(1, len(text) - window + 1), BLOCK - window + 1):
            part = text[low : low + BLOCK]
            if len(part) < window:
                continue
            if size + len(part) > BLOCK:
                yield b"".join(held), parts
                held, parts, size = [], [], 0
            held.append(part)
            parts.append((k, low, len(part)))
            size += len(part)
    if parts:
        yield b"".join(held), parts


def anchors_of(texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of all anchors, without repeats."""
    owner, place, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for data, parts in blocks(texts, window):
        lengths = np.array([p[2] for p in parts])
        bounds = np.cumsum(lengths)
        at, h = block_anchors(np.frombuffer(data, np.uint8), bounds, window, gram)
        k = np.searchsorted(bounds, at, side="right")
        owner.append(np.array([p[0] for p in parts])[k])
        place.append(at - (bounds - lengths)[k] + np.array([p[1] for p in parts])[k])
        value.append(h)
    owner, place, value = np.concatenate(owner), np.concatenate(place), np.concatenate(value)
    if len(owner) > 1:  # a cut text's overlap may give an anchor twice
        new = np.ones(len(owner), bool)
        order = np.lexsort((place, owner))
        owner, place, value = owner[order], place[order], value[order]
        new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
        owner, place, value = owner[new], place[new], value[new]
    return owner, place, value


def context(text: bytes, place: int, window: int = WINDOW, gram: int = GRAM) -> bytes:
    """The bytes of every window around an anchor, padded beyond the text."""
    side = window - gram
    low, high = place - side, place + gram + side
    return bytes([PAD]) * max(0, -low) + text[max(0, low) : high] + bytes([PAD]) * max(0, high - len(text))


def context_hashes(texts: list[bytes], owner: np.ndarray, place: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the context of each anchor, and of how far it reaches beyond its text."""
    side = window - gram
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = 1 << max(10, len(data).bit_length())
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, size)[: len(data)], out=sums[1:])
    low, high = place - side, place + gram + side
    a, b = starts[owner] + np.maximum(low, 0), starts[owner] + np.minimum(high, lengths[owner])
    clipped = np.maximum(-low, 0) * 4096 + np.maximum(high - lengths[owner], 0)
    return mix(mix((sums[b] - sums[a]) * powers(INVERSE, size)[a]) + clipped.astype(U))


def repeated_windows(contexts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """(n, places) flags: the window at that place of the context stands in another context at the same place.

    One symbol of every context is put in front each round, from the right; order and common prefixes are those
    of the suffixes so far. Time is linear in the bytes, memory two numbers a context beside them.
    """
    n, width = contexts.shape
    columns = np.ascontiguousarray(contexts.T)
    places = width - window + 1
    found = np.zeros((places, n), bool)
    order, shared = np.arange(n), np.zeros(n + 1, np.int32)  # shared[i]: of order[i - 1] and order[i]
    for c in range(width - 1, -1, -1):
        symbols = columns[c][order]
        rank = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[rank]
        before, now = rank[:-1], rank[1:]
        least = shared[now]
        apart = np.flatnonzero(now != before + 1)
        apart = apart[sorted_symbols[1:][apart] == sorted_symbols[:-1][apart]]
        if len(apart):
            least[apart] = np.minimum.reduceat(shared, np.stack([before[apart] + 1, now[apart] + 1], axis=1).reshape(-1))[::2]
        new = np.zeros(n + 1, np.int32)
        new[1:n] = np.where(sorted_symbols[1:] == sorted_symbols[:-1], least + 1, 0)
        order, shared = order[rank], new
        if c < places:
            hit = np.flatnonzero(shared[:n] >= window)
            found[c][order[hit]] = True
            found[c][order[hit - 1]] = True
    return found.T


def all_anchors(rows: DataFrame, window: int, gram: int, with_context: bool) -> DataFrame:
    """The anchors of (row_key, text): anchor alone, or row_key, place, anchor and context."""
    schema = "anchor long, row_key long, place int, context long" if with_context else "anchor long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            low = 0
            while low < len(texts):
                high, size, some = low, 0, []
                while high < len(texts) and size < 600_000:  # some hundred kB at a time: a few arrays of eight bytes a byte
                    some.append(texts[high].encode("utf-8", "surrogatepass"))
                    size += len(some[-1])
                    high += 1
                owner, place, value = anchors_of(some, window, gram)
                columns = [pa.array(value.view(np.int64))]
                if with_context:
                    columns += [pa.array(keys[low:high][owner]), pa.array(place.astype(np.int32)), pa.array(context_hashes(some, owner, place, window, gram).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "row_key", "place", "context"][: len(columns)])
                low = high

    return rows.mapInArrow(run, schema)


def cut_contexts(chosen: DataFrame, rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, row_key, place, lone, bytes) of the chosen anchors."""
    lists = chosen.groupBy("row_key").agg(F.collect_list(F.struct("place", "anchor", "lone")).alias("chosen"))
    both = lists.join(rows, "row_key").select("row_key", "text", "chosen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                part = batch.slice(low, 100)
                out: tuple = [], [], [], [], []
                for key, text, chosen in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = text.encode("utf-8", "surrogatepass")
                    for x in chosen:
                        for column, value in zip(out, (x["anchor"], key, x["place"], x["lone"], context(data, x["place"], window, gram)), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()), strict=True)], ["anchor", "row_key", "place", "lone", "bytes"])

    return both.mapInArrow(run, "anchor long, row_key long, place int, lone boolean, bytes binary")


def halved(contexts: DataFrame, window: int, gram: int) -> DataFrame:
    """Each context in the two halves of its range of windows, first to last, where it has a whole window.

    part is a hash of the bytes that all windows of the half hold, so contexts that share one of its windows share
    the part; whole is one of the bytes that any of them holds. low and high bound the half's windows in the text.
    """
    side, width = window - gram, gram + 2 * (window - gram)
    names = ["anchor", "row_key", "place", "lone", "bytes", "first", "last", "part", "whole", "low", "high"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    number = lambda *parts: int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = bytes([PAD])
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                out = []
                for anchor, key, place, lone, data, first, last in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True):
                    begin, end = width - len(data.lstrip(pad)), len(data.rstrip(pad)) - window
                    middle = (first + last) // 2
                    for a, b in {(first, middle), (min(middle + 1, last), last)}:
                        if max(a, begin) <= min(b, end):
                            head = b"%d %d %d " % (anchor, a, b)
                            start = place - side
                            out.append((anchor, key, place, lone, data, a, b, number(head, data[b : a + window]), number(head, data[a : b + window]), start + max(a, begin), start + min(b, end) + window))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return contexts.select(*names[:7]).mapInArrow(run, "anchor long, row_key long, place int, lone boolean, bytes binary, first int, last int, part long, whole long, low int, high int")


def parted(contexts: DataFrame, window: int, gram: int, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Contexts of hot anchors in parts of at most `most` (part, row_key, place, lone, bytes), and spans (row_key, low, high) found on the way.

    The range of windows of a part is halved until it is small. Contexts of a part that are equal over all its
    windows are repeats there; one of them goes on. A part of a single window holds one context, so this ends.
    """
    rest = contexts.select("*", F.lit(0).alias("first"), F.lit(window - gram).alias("last"))
    small, spans = [], []
    while True:
        rest = written(halved(rest, window, gram), "parts")
        node = ["anchor", "part", "whole"]
        kinds = written(rest.groupBy(*node).agg(F.count("*").alias("n"), F.min(F.struct("row_key", "place", "lone", "first", "last", "bytes")).alias("one")), "kinds")
        spans.append(rest.where("lone").join(kinds.where("n > 1").select(*node), node).select("row_key", "low", "high"))
        rest = kinds.select("anchor", "part", "one.row_key", "one.place", (F.col("one.lone") & (F.col("n") == 1)).alias("lone"), "one.first", "one.last", "one.bytes")
        hot = cut(rest.groupBy("anchor", "part").agg(F.count("*").alias("n")).where(F.col("n") > most).select("anchor", "part"))
        small.append(rest.join(F.broadcast(hot), ["anchor", "part"], "left_anti").select("part", "row_key", "place", "lone", "bytes"))
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, small), reduce(DataFrame.unionByName, spans)
        rest = rest.join(F.broadcast(hot), ["anchor", "part"], "left_semi")


def ordered_spans(contexts: DataFrame, window: int, gram: int, most: int = MOST) -> DataFrame:
    """(row_key, low, high) of the repeated windows of the lone contexts, from the column-wise order of each owner's parts.

    An owner holds whole parts, in runs of at most twice `most` contexts; no part is larger than `most`.
    """
    side, width = window - gram, gram + 2 * (window - gram)

    def spans(keys: np.ndarray, places: np.ndarray, lone: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
        found = repeated_windows(data, window)[lone]
        inside = data[lone] != PAD  # a window that reaches beyond its text is none
        at = np.arange(width - window + 1)
        found &= (at >= inside.argmax(axis=1)[:, None]) & (at + window <= width - inside[:, ::-1].argmax(axis=1)[:, None])
        found = found.astype(np.int8)
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))), axis=1)
        (i, a), (_, b) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        first = places[lone][i] - side
        low, high = first + a, first + b - 1 + window
        return pa.RecordBatch.from_arrays([pa.array(keys[lone][i]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["row_key", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            data = np.empty((table.num_rows, width), np.uint8)
            at = 0
            for chunk in table.column("bytes").chunks:
                flat = np.frombuffer(b"".join(chunk.to_pylist()), np.uint8).reshape(-1, width)
                data[at : at + len(flat)] = flat
                at += len(flat)
            keys, places, lone = table.column("row_key").to_numpy(), table.column("place").to_numpy().astype(np.int64), table.column("lone").to_numpy()
            order = np.lexsort((~lone, places, keys))  # a context of several parts counts once: it's no repeat of itself
            new = np.append(True, (np.diff(keys[order]) != 0) | (np.diff(places[order]) != 0))
            if not new.all():
                kept = np.sort(order[new])
                keys, places, lone, data = keys[kept], places[kept], lone[kept], data[kept]
            yield spans(keys, places, lone, data)
            held.clear()

        size, last = 0, None
        for batch in batches:
            parts = batch.column(0).to_numpy()
            begins = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(parts) else []
            for k, low in enumerate(begins):
                high = begins[k + 1] if k + 1 < len(begins) else len(parts)
                if size and parts[low] != last and size + (high - low) > most:
                    yield from flush()
                    size = 0
                held.append(batch.slice(low, high - low))
                size, last = size + int(high - low), parts[low]
        if size:
            yield from flush()

    owned = contexts.repartition("part").sortWithinPartitions("part")
    return owned.mapInArrow(run, "row_key long, low int, high int")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM, with_text: bool = False, most: int = MOST) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and (with_text) kept.

    Every byte that a repeated string of `window` bytes covers goes; strings are judged on the input, and none
    crosses rows. A null text counts as empty; texts below the window lose nothing; repeated rows are copies of
    each other. Other columns are not read; an empty table gives no rows. kept is binary: a cut may part a
    character.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
    rows = source.select(F.xxhash64("doc_id", "text").alias("row_key"), "text", "doc_id")
    keyed = rows.select("row_key", "text")
    side = window - gram
    # cut, so that both sides of the join below are plain exchanges: an anchor that many texts share is then split
    repeated = cut(all_anchors(keyed, window, gram, False).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"))
    found = written(all_anchors(keyed, window, gram, True).join(repeated.select("anchor"), "anchor"), "anchors")
    kinds = cut(found.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("row_key", "place")).alias("first")))
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    chosen = kinds.join(several, "anchor").select("anchor", "first.row_key", "first.place", (F.col("n") == 1).alias("lone"))
    copies = found.join(kinds.where("n > 1").select("anchor", "context"), ["anchor", "context"])
    whole = copies.select("row_key", (F.col("place") - side).alias("low"), (F.col("place") + gram + side).alias("high"))
    frequent = repeated.where(F.col("n") > most).select("anchor")
    hot = cut(kinds.join(F.broadcast(frequent), "anchor").groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > most).select("anchor"))
    if hot.isEmpty():
        apart = ordered_spans(cut_contexts(chosen, keyed, window, gram).withColumnRenamed("anchor", "part"), window, gram, most)
    else:
        usual = cut_contexts(chosen.join(F.broadcast(hot), "anchor", "left_anti"), keyed, window, gram).withColumnRenamed("anchor", "part")
        parts, known = parted(cut_contexts(chosen.join(F.broadcast(hot), "anchor", "left_semi"), keyed, window, gram), window, gram, most)
        apart = ordered_spans(usual.unionByName(parts), window, gram, most).unionByName(known)
    spans = whole.unionByName(apart).groupBy("row_key").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    joined = rows.join(spans, "row_key", "left").select("doc_id", "text", "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple = [], [], [], [], [], []
            for doc_id, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for low, high in sorted((max(0, x["low"]), min(len(data), x["high"])) for x in spans or ()):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                    else:
                        merged.append([low, high])
                at, kept = 0, []
                for low, high in merged:
                    kept.append(data[at:low])
                    at = high
                left = b"".join([*kept, data[at:]])
                row = doc_id, len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left if with_text else None
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)], names)

    result = joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return result if with_text else result.drop("kept")
