"""Benchmark decontamination by pigeonhole edit matching.

A test item that a text holds with at most k edits is split into k + 1 pieces, of which one then stands in
the text unchanged. All pieces of a block of items are found in one pass by an Aho-Corasick automaton; around
each hit the edit distance is taken with Myers' bit-parallel algorithm, and rows within the budget stay.

Halving the pieces over and over gives a tree in which a part of n pieces has a budget of n - 1 edits: a match
within the whole budget leaves some piece whose every enclosing part is within its own. So a hit is verified
from the smallest enclosing part outwards, and chance hits end after a few characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE, BLOCK_CHARS = 0.08, 4_000_000
PLAIN = re.compile(r"[\W_]+")
MATCHES = "doc_id long, item_id long, distance long, match_start long, match_end long"


def plain(text: str | None) -> str:
    """Runs of letters and digits in lower case, one space between."""
    return PLAIN.sub(" ", (text or "").lower()).strip()


def budget(item: str, error_rate: float = ERROR_RATE) -> int:
    return int(len(item) * error_rate)


def split_item(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces of nearly equal length that make up the item."""
    bounds = bounds_of(item, k)
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def bounds_of(item: str, k: int) -> list[int]:
    n = min(k + 1, len(item))
    return [len(item) * i // n for i in range(n + 1)]


def enclosing(item: str, k: int) -> dict[int, list[tuple[int, int, int, dict[str, int]]]]:
    """For the offset of each piece, the parts around it (start, end, budget, masks), small to large, without the whole item."""
    bounds, found = bounds_of(item, k), {}

    def halve(low: int, high: int, above: list) -> None:
        if high - low == 1:
            found[bounds[low]] = above[::-1]
            return
        own = above if high - low == len(bounds) - 1 else [*above, (bounds[low], bounds[high], high - low - 1, masks(item[bounds[low] : bounds[high]]))]
        halve(low, (low + high) // 2, own)
        halve((low + high) // 2, high, own)

    halve(0, len(bounds) - 1, [])
    return found


def masks(item: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, c in enumerate(item):
        found[c] = found.get(c, 0) | 1 << i
    return found


def myers(item: str, text: str, k: int, table: dict[str, int] | None = None, any_place: bool = False) -> tuple[int, int] | None:
    """(distance, end) of the best place of item in text, the first of equals, or (any_place) of the first; None beyond k edits."""
    table, m = masks(item) if table is None else table, len(item)
    if not m:
        return None
    all_bits, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = all_bits, 0, m, None
    for j, c in enumerate(text):
        eq = table.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & all_bits
        mh = plus & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & all_bits
        mh = (mh << 1) & all_bits
        plus = mh | ~(xv | ph) & all_bits
        minus = ph & xv
        if score <= k and (best is None or score < best[0]):
            best = (score, j + 1)
            if any_place:
                return best
    return best


class ItemBlock:
    """The automaton over the pieces of some items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        import ahocorasick

        self.items = [(item_id, p, budget(p, error_rate), masks(p)) for item_id, text in items if (p := plain(text))]
        places: dict[str, list[tuple[int, int, list]]] = {}
        for n, (_, item, k, _) in enumerate(self.items):
            around = enclosing(item, k)
            for offset, piece in split_item(item, k):
                places.setdefault(piece, []).append((n, offset, around[offset]))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best place of each item that stands in the normalised text."""
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        for end, (length, found) in self.automaton.iter(text):
            for n, offset, around in found:
                start, item = end + 1 - length - offset, self.items[n][1]
                if start not in starts.get(n, ()) and all(myers(item[a:b], text[max(0, start + a - k) : max(0, start + b + k)], k, table, True) for a, b, k, table in around):
                    starts.setdefault(n, set()).add(start)
        out = []
        for n, places in starts.items():
            item_id, item, k, table = self.items[n]
            best, reach = None, -1
            for low, high in merged(sorted(places), k):
                a, b = max(0, low - k), min(len(text), high + len(item) + k)
                if b - a < len(item) - k or best is not None and best[0] == 0 and b <= reach:
                    continue
                got = myers(item, text[a:b], k, table)
                if got is not None and (best is None or (got[0], a + got[1]) < best):
                    best = (got[0], a + got[1])
                reach = b
            if best is not None:
                back = myers(item[::-1], text[max(0, best[1] - len(item) - k) : best[1]][::-1], best[0])
                out.append((item_id, best[0], best[1] - (back[1] if back else len(item)), best[1]))
        return out


def merged(starts: list[int], k: int) -> Iterator[tuple[int, int]]:
    """Ranges of starts no further apart than the budget, each verified once."""
    low = high = starts[0]
    for s in starts[1:]:
        if s - high > k:
            yield low, high
            low = s
        high = s
    yield low, high


def item_blocks(benchmark: DataFrame, id_column: str, text_column: str, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of a bounded number of characters. A plan that uses a block keeps it: the benchmark is a stated set that the driver holds."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text")).where("text is not null").distinct()
    for row in rows.toLocalIterator():
        block.append((row.item_id, row.text))
        size += len(row.text)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_id_column: str = "item_id", item_text_column: str = "text", error_rate: float = ERROR_RATE) -> DataFrame:
    """One row per document row and item that it holds: doc_id, item_id, distance, match_start, match_end.

    Both sides are normalised (runs of letters and digits in lower case); places are in the normalised text.
    The least distance is given, at its first place. Null or empty texts and items match nothing. Rows that
    repeat are each reported; other columns are not read; empty tables give no rows. All items are matched
    against all rows, a block of items at a time.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    result = None
    for block in item_blocks(benchmark, item_id_column, item_text_column):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            found = ItemBlock(block, error_rate)
            for batch in batches:
                out = [(doc_id, *m) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in found.matches(plain(text))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] or [pa.array([], pa.int64())] * 5, ["doc_id", "item_id", "distance", "match_start", "match_end"])

        got = rows.mapInArrow(run, MATCHES)
        result = got if result is None else result.unionByName(got)
    return docs.sparkSession.createDataFrame([], MATCHES) if result is None else result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows of documents that hold no item within the error budget, with all their columns."""
    for block in item_blocks(benchmark, "item_id", "text"):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            found = ItemBlock(block, error_rate)
            for batch in batches:
                yield batch.filter(pa.array([not found.matches(plain(t)) for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
