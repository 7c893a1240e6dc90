"""PR14: metadata of a form from its path, by one native fold over the path's parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formloom.functions.text import ascii_digits

# Patterns of the path parts. Digits are those of any script.
SP, ND = r"(?U:\s)", r"\p{Nd}"
CONSTITUENCY = rf"เขตเลือกตั้งที่{SP}*({ND}+)"
AMPHOE = rf"(?:{ND}+\.)?{SP}*(?:อำเภอ|อ\.|เทศบาลนคร|เทศบาลเมือง){SP}*(.+?)(?:{SP}+5[-/]?1[78].*)?$"
TAMBON = rf"(?i)(?:{ND}+\.)?{SP}*(?:ตำบล|ต\.|ทม\.|ทต\.|อบต\.){SP}*(.+?)(?:\.pdf)?(?:{SP}+รวม)?$"
TAMBON_BARE = rf"^([ก-๙]+(?:(?:[ก-๙]|{SP})*[ก-๙]+)?){SP}+ชุดที่"
PARTYLIST, DISTRICT = "บัญชีรายชื่อ|บช", "แบ่งเขต|แบบแบ่งเขต"
FORM_NUMBER = rf"(?:ส\.?ส\.?|แบบ{SP}*ส\.?ส\.?){SP}*5[-/]?1[78]"
UNIT = rf"หน่วย(?:ที่)?{SP}*({ND}+)|น\.?{SP}*({ND}+)"
ADVANCE = "นอกเขต"


def first(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without a match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def number(s: Column) -> Column:
    return ascii_digits(s).try_cast("int")


def form_type(text: Column) -> Column:
    return F.when(text.rlike(PARTYLIST), F.lit("partylist")).when(text.rlike(DISTRICT) | text.rlike(FORM_NUMBER), F.lit("district"))


def path_metadata(path: Column) -> Column:
    """Struct of province, constituency, amphoe, tambon, form_type, unit_number, is_advance_voting, raw_path."""
    parts = F.filter(F.split(F.translate(path, "\\", "/"), "/"), lambda p: p != "")
    lead = F.aggregate(parts, F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), lambda a, p: F.when(a["go"] & F.lower(p).isin("data", "raw"), F.struct((a["n"] + 1).alias("n"), F.lit(True).alias("go"))).otherwise(F.struct(a["n"].alias("n"), F.lit(False).alias("go"))), lambda a: a["n"])
    rest = F.slice(parts, lead + 1, F.size(parts))
    head = F.get(rest, F.lit(0))
    province = F.when(~head.rlike(CONSTITUENCY), head)
    body = F.when(province.isNotNull(), F.slice(rest, 2, F.size(rest))).otherwise(rest)
    none = F.lit(None).cast("string")
    start = F.struct(F.lit(None).cast("int").alias("constituency"), none.alias("amphoe"), none.alias("tambon"), none.alias("form_type"), F.lit(False).alias("advance"))

    def step(a: Column, raw: Column) -> Column:
        seg = F.regexp_replace(raw, r"(?i)\.pdf$", "")
        con, amp, tam = first(seg, CONSTITUENCY), first(seg, AMPHOE), first(seg, TAMBON)
        take_con = con.isNotNull() & a["constituency"].isNull()
        take_amp = ~take_con & amp.isNotNull() & a["amphoe"].isNull()
        take_tam = ~take_con & ~take_amp & tam.isNotNull() & a["tambon"].isNull()
        take_form = ~take_con & ~take_amp & ~take_tam & a["form_type"].isNull()
        return F.struct(
            F.when(take_con, number(con)).otherwise(a["constituency"]).alias("constituency"),
            F.when(take_amp, F.trim(amp)).otherwise(a["amphoe"]).alias("amphoe"),
            F.when(take_tam, F.trim(tam)).otherwise(a["tambon"]).alias("tambon"),
            F.when(take_form, form_type(seg)).otherwise(a["form_type"]).alias("form_type"),
            (a["advance"] | (~take_con & seg.contains(ADVANCE))).alias("advance"),
        )

    folded = F.aggregate(body, start, step)
    tail = F.slice(parts, F.greatest(F.size(parts) - 2, F.lit(1)), F.lit(3))
    with_unit = F.filter(tail, lambda p: p.rlike(UNIT))
    unit_part = F.get(with_unit, F.lit(0))
    unit = number(F.coalesce(F.nullif(F.regexp_extract(unit_part, UNIT, 1), F.lit("")), F.nullif(F.regexp_extract(unit_part, UNIT, 2), F.lit(""))))
    name = F.regexp_replace(F.get(parts, F.size(parts) - 1), r"(?i)\.pdf$", "")
    some = F.size(parts) > 0
    return F.struct(
        F.when(some, province).alias("province"),
        folded["constituency"].alias("constituency"),
        folded["amphoe"].alias("amphoe"),
        F.coalesce(folded["tambon"], F.when(some, F.trim(first(name, TAMBON_BARE)))).alias("tambon"),
        F.coalesce(folded["form_type"], F.when(some, form_type(name))).alias("form_type"),
        unit.alias("unit_number"),
        folded["advance"].alias("is_advance_voting"),
        path.alias("raw_path"),
    )
