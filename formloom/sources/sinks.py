"""Sinks: JSON, text, images, CSV reports and manifests (SK1-SK12, SK16). Each job, or each file, commits as a whole."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_files(rows: DataFrame) -> int:
    """SK1, SK2, SK3, SK7: writes a file a row (path, content), each under another name first and then renamed; how many.

    A task that is run again writes the same files. A null content is an empty file.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, place = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
                folder = place.rsplit("/", 1)[0]
                store.create_dir(folder, recursive=True)
                other = f"{folder}/.{uuid.uuid4().hex}.tmp"
                with store.open_output_stream(other, compression=None) as out:
                    out.write(content or b"")
                store.move(other, place)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return rows.select("path", "content").mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def png(image: np.ndarray) -> bytes:
    """SK2: an image (grey, or red, green and blue) as a PNG file."""
    h, w = image.shape[:2]
    rows = np.ascontiguousarray(image, np.uint8).reshape(h, -1)
    raw = np.hstack([np.zeros((h, 1), np.uint8), rows]).tobytes()
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def crops(pages: DataFrame, plan: DataFrame, dpi: int = 200) -> DataFrame:
    """SK10, SK11: (path, content) of the PNG crops of a plan (rel_path, page_num, path, x0, y0, x1, y1; in points) from rendered pages.

    A rectangle is cut to the page; without any of it there is no crop.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                image = np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"], -1)
                low_x, low_y, high_x, high_y = (round(r[c] * dpi / 72) for c in ("x0", "y0", "x1", "y1"))
                part = image[max(0, low_y) : max(0, high_y), max(0, low_x) : max(0, high_x)]
                if part.size:
                    out.append({"path": r["path"], "content": png(part[:, :, 0] if r["channels"] == 1 else part[:, :, :3])})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("path", pa.string()), ("content", pa.binary())]))

    both = pages.where("pixels is not null").join(plan, ["rel_path", "page_num"])
    return both.select("path", "height", "width", "channels", "pixels", "x0", "y0", "x1", "y1").mapInArrow(run, "path string, content binary")


def write_json(rows: DataFrame, path: str) -> None:
    """SK1, PR30: JSON lines; structs, arrays, dates and numbers as JSON has them."""
    rows.write.mode("overwrite").json(path)


def write_text(rows: DataFrame, column: str, path: str) -> None:
    """SK3, SK16."""
    rows.select(F.col(column).cast("string").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_report(rows: DataFrame, columns: list[str], path: str) -> None:
    """SK6: a CSV report of fixed columns; columns that aren't there are empty, others are left out."""
    own = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]
    rows.select(*own).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def append_manifest(rows: DataFrame, path: str, seq: int | None = None) -> None:
    """SK4, SK5: appends JSON lines; seq numbers the run, so that the last one of a key can be told."""
    out = rows if seq is None else rows.withColumn("seq", F.lit(seq).cast("bigint"))
    out.write.mode("append").json(path)


def crop_plan(inputs: DataFrame, existing: DataFrame, kind: str, unknown: str = "skip", overwrite: bool = False) -> DataFrame:
    """SK12: (rel_path, kind, out_path) of what is to be cropped.

    unknown: what to do with files of no kind: skip, district or partylist.
    """
    if unknown not in ("skip", "district", "partylist"):
        raise ValueError(f"unknown policy {unknown}")
    kinds = inputs.withColumn("kind", F.col(kind) if unknown == "skip" else F.coalesce(kind, F.lit(unknown))).where("kind is not null")
    plan = kinds.select("rel_path", "kind", F.concat(F.lit("cropped/"), "kind", F.lit("/"), F.element_at(F.split("rel_path", "/"), -1)).alias("out_path"))
    return plan if overwrite else plan.join(existing.select("out_path").distinct(), "out_path", "left_anti").select("rel_path", "kind", "out_path")


def cell_table(rows: DataFrame, key: str) -> DataFrame:
    """SK10: the cells of each table as one JSON text."""
    cells = F.array_sort(F.collect_list(F.struct("row", "col", "x", "y", "w", "h")))
    return rows.groupBy(key).agg(F.to_json(cells).alias("cells"))
