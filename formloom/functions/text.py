"""Scalar functions over text and numbers: Column in, Column out, no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

THAI_DIGITS, ASCII_DIGITS = "๐๑๒๓๔๕๖๗๘๙", "0123456789"
KB = 1024


def ascii_digits(s: Column) -> Column:
    """PR1: Thai digits become ASCII digits; all else stays."""
    return F.translate(s, THAI_DIGITS, ASCII_DIGITS)


def digits_and_dots(s: Column) -> Column:
    """PR2: only digits and dots, after PR1."""
    return F.regexp_replace(ascii_digits(s), r"[^\p{Nd}.]", "")


def parse_int(s: Column) -> Column:
    """PR3: the number that a text's digits make, whatever stands between them; none: null."""
    return F.nullif(F.regexp_replace(ascii_digits(s.cast("string")), "[^0-9]", ""), F.lit("")).try_cast("bigint")


def strict_int(s: Column) -> Column:
    """PR4: a text that is a whole number; anything else: null."""
    return F.trim(ascii_digits(s)).try_cast("bigint")


def range_check(value: Column, low: int, high: int) -> Column:
    """PR5: pass, or a warning for null or out-of-range values."""
    return (
        F.when(value.isNull(), F.lit("warning: empty_or_non_numeric"))
        .when((value >= low) & (value <= high), F.lit("pass"))
        .otherwise(F.format_string(f"warning: out_of_range (%d not in [{low},{high}])", value))
    )


def triage(confidence: Column, auto: float = 0.70, review: float = 0.40) -> Column:
    """PR6: status by confidence; null counts as 0."""
    c = F.coalesce(confidence, F.lit(0.0))
    return F.when(c >= auto, F.lit("auto_accepted")).when(c >= review, F.lit("review_queue")).otherwise(F.lit("manual_entry"))


def human_bytes(n: Column) -> Column:
    """PR8: base 1024, '0 B' for none, whole bytes, else two decimals, half to even, up to TB; sizes below 0 keep their sign."""
    shown = lambda power, unit: F.format_string(f"%.2f {unit}", F.bround(n / float(KB**power), 2))
    out = shown(4, "TB")
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB")):
        out = F.when(F.abs(n) < KB ** (power + 1), shown(power, unit)).otherwise(out)
    return F.when(n == 0, F.lit("0 B")).when(F.abs(n) < KB, F.format_string("%d B", n)).otherwise(out)


SIZE_BUCKETS = ((500 * KB**2, "<500 MB"), (KB**3, "<1 GB"), (5 * KB**3, "<5 GB"), (10 * KB**3, "<10 GB"), (20 * KB**3, "<20 GB"))
ALL_BUCKETS = ("0 B", *(label for _, label in SIZE_BUCKETS), "20 GB+")


def size_bucket(n: Column) -> Column:
    """PR9: label of a size."""
    out = F.when(n == 0, F.lit("0 B"))
    for limit, label in SIZE_BUCKETS:
        out = out.when(n < limit, F.lit(label))
    return out.otherwise(F.lit("20 GB+"))


# Public mail domains of personal accounts.
PERSONAL = ("gmail.com", "hotmail.com", "outlook.com")


def email_class(address: Column, official_domain: str = "ect.go.th", marker: str = "ect") -> Column:
    """PR10: class of an account; the first that fits."""
    a = F.lower(F.coalesce(address, F.lit("")))
    personal = F.lit(False)
    for domain in PERSONAL:
        personal = personal | a.endswith("@" + domain)
    return (
        F.when(a == "", F.lit("error"))
        .when(a.endswith("@" + official_domain), F.lit("official"))
        .when(a.contains(marker), F.lit("ect_gmail"))
        .when(personal, F.lit("personal"))
        .otherwise(F.lit("institutional"))
    )


def clean_cell(s: Column) -> Column:
    """PR11: one line, trimmed; nan and none are empty."""
    t = F.trim(F.regexp_replace(F.coalesce(s.cast("string"), F.lit("")), "\n", " "))
    return F.when(F.lower(t).isin("nan", "none"), F.lit("")).otherwise(t)


def filename_class(name: Column) -> Column:
    """PR12: class of a file name's stem."""
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    return (
        F.when(stem.rlike(r"^\p{Nd}+$"), F.lit("numeric"))
        .when(stem.rlike(r"^\p{Nd}+\s*-\s*\p{Nd}+$"), F.lit("numeric-range"))
        .when(stem.rlike(r"^[\x00-\x7F]+$"), F.lit("ascii"))
        .otherwise(F.lit("thai-or-mixed"))
    )


def kind_of_path(path: Column) -> Column:
    """PR13, TF2: district or partylist, from any component; district first."""
    parts = F.split(F.lower(path), "/")
    return F.when(F.array_contains(parts, "district"), F.lit("district")).when(F.array_contains(parts, "partylist"), F.lit("partylist"))


def folder_id(url: Column) -> Column:
    """PR15: the id after 'folders/', '' if none."""
    return F.regexp_extract(url, "folders/([a-zA-Z0-9_-]+)", 1)


def fingerprint(length: Column, modified: Column) -> Column:
    """PR16: SHA-1 of 'size:seconds'."""
    return F.sha1(F.concat(length.cast("string"), F.lit(":"), F.unix_timestamp(modified).cast("string")).cast("binary"))


def unfenced_json(text: Column, schema: str) -> Column:
    """PR17: JSON out of a Markdown fence; null where it isn't valid."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))
    return F.from_json(plain, schema)


def embedded_fingerprint(text: Column, lines: int = 12) -> Column:
    """PR18: fingerprint that one of the first lines holds in a comment, '' if none."""
    head = F.array_join(F.slice(F.split(text, "\n"), 1, lines), "\n")
    return F.regexp_extract(head, r"<!--\s*fingerprint=(.*?)\s*-->", 1)


def zone_pixels(low: Column, high: Column, size: Column) -> Column:
    """PR19: fractions as pixels, half to even, clamped and in order."""
    a = F.greatest(F.lit(0), F.least(size, F.bround(low * size).cast("int")))
    b = F.greatest(F.lit(0), F.least(size, F.bround(high * size).cast("int")))
    return F.struct(F.least(a, b).alias("y0"), F.greatest(a, b).alias("y1"))


def clamp_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """PR20: the part of a box that lies in an image (x, y, w, h; of no area beyond it)."""
    x0, y0 = F.greatest(F.lit(0), F.least(x, width)), F.greatest(F.lit(0), F.least(y, height))
    x1, y1 = F.greatest(F.lit(0), F.least(x + w, width)), F.greatest(F.lit(0), F.least(y + h, height))
    return F.struct(x0.alias("x"), y0.alias("y"), F.greatest(F.lit(0), x1 - x0).alias("w"), F.greatest(F.lit(0), y1 - y0).alias("h"))


def pad_box(x: Column, y: Column, w: Column, h: Column, by: int) -> Column:
    """PR20: a box that is wider on every side."""
    return F.struct((x - by).alias("x"), (y - by).alias("y"), (w + 2 * by).alias("w"), (h + 2 * by).alias("h"))


def box_area(w: Column, h: Column) -> Column:
    """PR36: area, of sides no smaller than 0."""
    return F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)


def crop_rect(unit: str, x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, dpi: int = 200) -> Column:
    """PR21, SK11: a rectangle in norm, pt or px cut to the page, in points; null where nothing is left."""
    per_x, per_y = {"norm": (width, height), "pt": (F.lit(1.0), F.lit(1.0)), "px": (F.lit(72.0 / dpi), F.lit(72.0 / dpi))}[unit]
    a, b = F.greatest(F.lit(0.0), F.least(x0, x1) * per_x), F.least(width, F.greatest(x0, x1) * per_x)
    c, d = F.greatest(F.lit(0.0), F.least(y0, y1) * per_y), F.least(height, F.greatest(y0, y1) * per_y)
    return F.when((b > a) & (d > c), F.struct(a.alias("x0"), c.alias("y0"), b.alias("x1"), d.alias("y1")))


def parse_rect(text: Column) -> Column:
    """PR22: 'x0,y0,x1,y1' as doubles; null unless it has four numbers."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("double"))
    good = (F.size(parts) == 4) & F.forall(parts, lambda p: p.isNotNull())
    return F.when(good, F.struct(*(F.get(parts, k).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1")))))


def scale_list(text: Column, most: int = 2000) -> Column:
    """PR23: 'a,b,c', or 'start:stop:step' with the stop; null where the step isn't above 0 or the list is too long."""
    part = F.split(text, ":")
    start, stop, step = (F.get(part, k).try_cast("double") for k in range(3))
    n = F.floor((stop - start + 1e-9) / step).cast("int")
    ranged = F.when((step > 0) & (n >= 0) & (n < most), F.transform(F.sequence(F.lit(0), n), lambda i: start + i * step))
    listed = F.transform(F.filter(F.split(text, ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).try_cast("double"))
    return F.when(text.contains(":"), ranged).otherwise(listed)


def fraction_range(text: Column) -> Column:
    """PR24: 'a,b' clamped to 0..1 and in order."""
    part = F.split(text, "[,:]")
    a, b = (F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.trim(F.get(part, k)).try_cast("double"))) for k in range(2))
    return F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))


def language_codes(hints: Column) -> Column:
    """PR29: OCR languages joined by '+', th as tha, without repeats."""
    return F.array_join(F.array_distinct(F.transform(hints, lambda x: F.when(F.lower(x) == "th", F.lit("tha")).when(F.lower(x) == "en", F.lit("eng")).otherwise(F.lower(x)))), "+")


def env_flag(s: Column) -> Column:
    """PR31: whether a setting is on."""
    return F.lower(F.trim(F.coalesce(s, F.lit("")))).isin("1", "true", "yes", "on")


def path_stem(path: Column) -> Column:
    """PR32: a path without its last suffix."""
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", "")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def mirrored(path: Column, in_root: str, out_root: str) -> Column:
    """SK7: the place below out_root of a file below in_root, without its suffix."""
    return path_stem(F.concat(F.lit(out_root.rstrip("/")), F.substring(path, len(in_root.rstrip("/")) + 1, 1_000_000)))


def without_last_dash(s: Column) -> Column:
    """PR35: what stands before the last dash."""
    return F.regexp_replace(s, "-[^-]*$", "")


def comma_list(s: Column) -> Column:
    """PR37: items of a comma list, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != "")


def region_id(doc: Column, page: Column, what: Column) -> Column:
    """PR34: id of a region."""
    return F.format_string("doc%d_p%d_%s", doc, page, what)


def region_document(region: Column) -> Column:
    """PR34: document number of a region id; null if it has none."""
    return F.regexp_extract(region, "^doc([0-9]+)_", 1).try_cast("int")


def field_number(region: Column) -> Column:
    """PR25: 1 to 8 of an id that ends in field_n; null otherwise."""
    return F.regexp_extract(region, "field_([1-8])$", 1).try_cast("int")
