"""Packing of token sequences: first-fit decreasing over a tournament tree, in randomised groups of documents.

A document of more than a sequence is cut into whole sequences and a rest. Groups are drawn by a hash, so
that each is a fair sample of the lengths; within one, pieces go by falling length into the first sequence
with room, found in O(log n) in a tree whose nodes hold the greatest room below them.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH, DOCS_PER_GROUP = 1024, 5000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class RoomTree:
    """Tournament tree over bins: each node holds the greatest room of the bins below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [room] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """First bin with room for size, and the room that it had."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        had = room[node]
        room[node] -= size
        at = node
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
        return node - self.leaves, had


def first_fit_decreasing(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int]]:
    """(bin, offset) of each size, in the order given; equal sizes go in the order given. Sizes are at most length."""
    full, out = 0, [(0, 0)] * len(sizes)
    rest = []
    for k, size in enumerate(sizes):
        if size >= length:  # a bin of its own, without a search
            out[k], full = (full, 0), full + 1
        else:
            rest.append(k)
    tree = RoomTree(max(1, len(rest)), length)
    for k in sorted(rest, key=lambda k: -sizes[k]):
        number, had = tree.place(sizes[k])
        out[k] = (full + number, length - had)
    return out


# Fixed value: the splitting rule of the byte-level vocabulary, with possessive quantifiers.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoding(path: str):
    """(encoder, added tokens, their pattern) with the ids of a tokenizers file of kind byte-level BPE, whose ids rank its merges.

    Added tokens that take in neighbouring spaces or stand as single words only are refused.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    added = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
    if any(t.get(k) for t in model.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"added tokens of {path} are not plain strings")
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in token): rank for token, rank in model["model"]["vocab"].items() if token not in added}
    pattern = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
    return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}), added, pattern


def packed_ids(text: str, path: str) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit integers; an added token's string is that token, as in `tokenizers`."""
    encoder, added, pattern = encoding(path)
    ids = array("I")
    for k, part in enumerate(pattern.split(text) if pattern else [text]):
        ids.extend([added[part]] if k % 2 else encoder.encode_ordinary(part))
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def pieces(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """The pieces of each document, in token places: doc_id, start, length, ids_crc32, doc_tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = struct.pack("<I", end_id)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low in range(0, len(ids), 200):
                out = []
                for doc_id, text in zip(ids[low : low + 200], texts[low : low + 200], strict=True):
                    packed = packed_ids(text or "", tokenizer_path) + end
                    n = len(packed) // 4
                    for start in range(0, n, length):
                        part = packed[4 * start : 4 * (start + length)]
                        out.append((doc_id, start, len(part) // 4, zlib.crc32(part), n))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def pack(found: DataFrame, n_groups: int, length: int = LENGTH) -> DataFrame:
    """Adds sequence_id and offset to pieces. A group's pieces are packed alone; its number leads its sequence ids.

    The group is drawn for a document (its id and its number of tokens), so a document's pieces stay together.
    """
    group = F.pmod(F.xxhash64("doc_id", "doc_tokens", F.lit(17)), F.lit(n_groups))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")]
        table = table.sort_by(order)
        places = first_fit_decreasing(table.column("length").to_pylist(), length)
        number, offset = (np.array(c, dtype=np.int64) for c in zip(*places, strict=True))
        base = key[0].as_py() << 32
        return table.drop_columns(["pack_group"]).append_column("sequence_id", pa.array(number + base)).append_column("offset", pa.array(offset))

    return found.withColumn("pack_group", group).groupBy("pack_group").applyInArrow(run, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text counts as empty: one piece with the end id alone. A null id is kept. Repeated rows are packed
    each; pieces of rows alike in id and number of tokens share a group. Other columns are not read; an empty
    table gives no rows.
    """
    n_groups = max(1, -(-docs.count() // docs_per_group))
    return pack(pieces(docs, tokenizer_path, id_column, text_column, length), n_groups, length)
