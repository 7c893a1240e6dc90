"""External calls (rendering, OCR, vision models) in Arrow batches: errors are rows, never failed tasks (SC3-SC6, SC16, C10-C13, PR17)."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Renderer(Protocol):
    """Yields (page number, height, width, channels, pixels) of a file's pages."""

    def __call__(self, content: bytes) -> Iterator[tuple[int, int, int, int, bytes]]: ...


PAGE = "rel_path string, page_num int, height int, width int, channels int, pixels binary, error string"
PAGE_SCHEMA = pa.schema([("rel_path", pa.string()), ("page_num", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("pixels", pa.binary()), ("error", pa.string())])


def error_class(e: Exception) -> str:
    """password, corrupt or the exception's name."""
    text = str(e).lower()
    return "password" if "password" in text or "encrypt" in text else "corrupt" if "corrupt" in text or "damaged" in text else type(e).__name__


def rendered_pages(files: DataFrame, primary: Renderer, fallback: Renderer | None = None) -> DataFrame:
    """SC3, SC5, SC6: a row per page of (rel_path, content); a file that can't be read gives one row with its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                error = None
                for renderer in (primary, fallback):
                    if renderer is None:
                        continue
                    try:
                        for n, h, w, c, pixels in renderer(row["content"]):
                            yield pa.RecordBatch.from_pylist([{"rel_path": row["rel_path"], "page_num": n, "height": h, "width": w, "channels": c, "pixels": pixels, "error": None}], PAGE_SCHEMA)
                        error = None
                        break
                    except Exception as e:  # noqa: BLE001  any failure of a provider becomes a row
                        error = error_class(e)
                        if error == "password":
                            break
                if error:
                    yield pa.RecordBatch.from_pylist([{"rel_path": row["rel_path"], "page_num": None, "height": None, "width": None, "channels": None, "pixels": None, "error": error}], PAGE_SCHEMA)

    return files.select("rel_path", "content").mapInArrow(run, PAGE)


def page_counts(files: DataFrame, count: Callable[[bytes], int]) -> DataFrame:
    """SC6: (rel_path, n_pages, error) of (rel_path, content), by a provider that counts without rendering."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                found = {"rel_path": row["rel_path"], "n_pages": None, "error": None}
                try:
                    found["n_pages"] = count(row["content"])
                except Exception as e:  # noqa: BLE001  any failure of a provider becomes a row
                    found["error"] = error_class(e)
                out.append(found)
            yield pa.RecordBatch.from_pylist(out, pa.schema([("rel_path", pa.string()), ("n_pages", pa.int32()), ("error", pa.string())]))

    return files.select("rel_path", "content").mapInArrow(run, "rel_path string, n_pages int, error string")


def rendered_page(items: DataFrame, render: Callable[[bytes, int, int], tuple[int, int, int, bytes]], dpi: int = 200) -> DataFrame:
    """SC5: one page of each of (rel_path, page_num, content) at a resolution; render gives height, width, channels and pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                page = dict.fromkeys(PAGE_SCHEMA.names) | {"rel_path": row["rel_path"], "page_num": row["page_num"]}
                try:
                    page |= dict(zip(("height", "width", "channels", "pixels"), render(row["content"], row["page_num"], dpi), strict=True))
                except Exception as e:  # noqa: BLE001  any failure of a provider becomes a row
                    page["error"] = error_class(e)
                yield pa.RecordBatch.from_pylist([page], PAGE_SCHEMA)

    return items.select("rel_path", F.col("page_num").cast("int").alias("page_num"), "content").mapInArrow(run, PAGE)


def decoded_images(files: DataFrame, decode: Callable[[bytes], tuple[int, int, int, bytes]]) -> DataFrame:
    """SC7: image files (rel_path, content) as pages of one each."""
    return rendered_page(files.withColumn("page_num", F.lit(0)), lambda content, page, dpi: decode(content))


ROWS = pa.schema([("rel_path", pa.string()), ("page", pa.int32()), ("row_no", pa.int32()), ("cells", pa.list_(pa.string())), ("error", pa.string())])


def table_rows(files: DataFrame, extract: Callable[[bytes], Iterator[tuple[int, list[list[str]]]]]) -> DataFrame:
    """SC16, C16: the rows of the tables of each file (rel_path, content): rel_path, page, row_no, cells, error.

    extract yields a page and the rows of one of its tables at a time; a page's tables follow each other. A failure ends
    its file with an error row. survey.page_tables makes columns of the cells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place = {"rel_path": row["rel_path"]}
                seen: dict[int, int] = {}
                try:
                    for page, rows in extract(row["content"]):
                        at = seen.get(page, 0)
                        seen[page] = at + len(rows)
                        yield pa.RecordBatch.from_pylist([place | {"page": page, "row_no": at + k, "cells": cells, "error": None} for k, cells in enumerate(rows)], ROWS)
                except Exception as e:  # noqa: BLE001  any failure of a provider becomes a row
                    yield pa.RecordBatch.from_pylist([place | {"page": None, "row_no": None, "cells": None, "error": error_class(e)}], ROWS)

    return files.select("rel_path", "content").mapInArrow(run, "rel_path string, page int, row_no int, cells array<string>, error string")


def asked(items: DataFrame, key: str, call: Callable[[str], str], tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """SC14: (key, answer, error) of calls to a remote folder's tool, such as its size or its owner; answers are text, as JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in batch.column(0).to_pylist():
                found = {"key": k, "answer": None, "error": None}
                try:
                    found["answer"] = with_retry(lambda k=k: call(k), tries, sleep=sleep)
                except Exception as e:  # noqa: BLE001  any failure of a provider becomes a row
                    found["error"] = f"{type(e).__name__}: {e}"[:500]
                out.append(found)
            yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), ("answer", pa.string()), ("error", pa.string())]))

    return items.select(F.col(key).cast("string").alias("key")).distinct().mapInArrow(run, "key string, answer string, error string")


def same_width(pages: DataFrame) -> DataFrame:
    """SC4: pages padded on the right with white to the widest of their file."""
    widest = pages.groupBy("rel_path").agg(F.max("width").alias("widest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                wide = r.pop("widest")
                if r["pixels"] is not None and r["width"] < wide:
                    image = np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"], r["channels"])
                    r |= {"pixels": np.pad(image, ((0, 0), (0, wide - r["width"]), (0, 0)), constant_values=255).tobytes(), "width": wide}
                out.append(r)
            yield pa.RecordBatch.from_pylist(out, PAGE_SCHEMA)

    return pages.join(widest, "rel_path").select("rel_path", "page_num", "height", "width", "channels", "pixels", "error", "widest").mapInArrow(run, PAGE)


def with_retry(call: Callable[[], str], tries: int = 4, base: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> str:
    """Calls again after base * 2**attempt seconds and up to a second more; the last failure is raised."""
    for attempt in range(tries):
        try:
            return call()
        except Exception:
            if attempt == tries - 1:
                raise
            sleep(base * 2**attempt + random.random())
    raise AssertionError


CALL = "rel_path string, page_num int, fingerprint string, status string, extraction string, model string, seconds double, error string"
CALL_SCHEMA = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}[t]) for n, t in (f.split() for f in CALL.split(", "))])


def call_model(items: DataFrame, model: str, call: Callable[[dict], str], workers: int, per_second: float | None = None, tries: int = 4) -> DataFrame:
    """A manifest row per item (rel_path, page_num, fingerprint): ok with valid JSON, or error.

    workers partitions take the place of a pool; the rate is shared out among them. Calls should be idempotent by
    (rel_path, page_num, fingerprint): a lost executor's items are called again.
    """
    pause = workers / per_second if per_second else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = 0.0
        for batch in batches:
            for row in batch.to_pylist():
                time.sleep(max(0.0, last + pause - time.monotonic()))
                last = began = time.monotonic()
                out = {"rel_path": row["rel_path"], "page_num": row["page_num"], "fingerprint": row["fingerprint"], "model": model, "extraction": None, "error": None}
                try:
                    text = with_retry(lambda row=row: call(row), tries).strip()
                    text = text.removeprefix("```json").removeprefix("```").removesuffix("```").strip()
                    json.loads(text)
                    out |= {"status": "ok", "extraction": text}
                except Exception as e:  # noqa: BLE001  any failure of a provider becomes a row
                    out |= {"status": "error", "error": f"{type(e).__name__}: {e}"[:500]}
                yield pa.RecordBatch.from_pylist([out | {"seconds": time.monotonic() - began}], CALL_SCHEMA)

    return items.select("rel_path", "page_num", "fingerprint").repartition(workers, "rel_path", "page_num").mapInArrow(run, CALL)
