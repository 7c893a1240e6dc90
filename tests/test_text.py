import hashlib

from pyspark.sql import functions as F

from formloom.functions import text as T
from formloom.functions.paths import path_metadata
from formloom.plans.forms_queries import PATHS


def one(spark, *columns):
    return list(spark.range(1).select(*columns).first())


def test_parse_int(spark):
    values = ["77", "9,041", None, "", "xy", "-12", "31.5", "๔๕", "๓ of ๙"]
    assert one(spark, *(T.parse_int(F.lit(v).cast("string")) for v in values)) == [77, 9041, None, None, None, 12, 315, 45, 39]


def test_strict_int(spark):
    assert one(spark, *(T.strict_int(F.lit(v)) for v in ["31", " 8 ", "7x", "4,4", "๖๐", ""])) == [31, 8, None, None, 60, None]


def test_range_and_triage(spark):
    assert one(spark, *(T.range_check(F.lit(v).cast("bigint"), 0, 10) for v in (None, 5, 11))) == ["warning: empty_or_non_numeric", "pass", "warning: out_of_range (11 not in [0,10])"]
    assert one(spark, *(T.triage(F.lit(v).cast("double")) for v in (0.7, 0.69, 0.4, 0.39, None))) == ["auto_accepted", "review_queue", "review_queue", "manual_entry", "manual_entry"]


def test_bytes_and_buckets(spark):
    assert one(spark, *(T.human_bytes(F.lit(v).cast("bigint")) for v in (0, 700, 2560, 123456789, 5 * 1024**5, -2048, -3, 19584))) == ["0 B", "700 B", "2.50 KB", "117.74 MB", "5120.00 TB", "-2.00 KB", "-3 B", "19.12 KB"]
    assert one(spark, *(T.size_bucket(F.lit(v).cast("bigint")) for v in (0, 1, 500 * 1024**2, 20 * 1024**3))) == ["0 B", "<500 MB", "<1 GB", "20 GB+"]


def test_classes(spark):
    mails = ["k@ect.go.th", "north.ect@hotmail.com", "m@outlook.com", "r@school.ac.th", ""]
    assert one(spark, *(T.email_class(F.lit(m)) for m in mails)) == ["official", "ect_gmail", "personal", "institutional", "error"]
    names = ["12.pdf", "1-3.pdf", "scan 1.pdf", "หน่วย1.pdf", "๑๒.pdf"]
    assert one(spark, *(T.filename_class(F.lit(n)) for n in names)) == ["numeric", "numeric-range", "ascii", "thai-or-mixed", "numeric"]
    assert one(spark, *(T.kind_of_path(F.lit(p)) for p in ("a/partylist/district/x", "PartyList/x", "x"))) == ["district", "partylist", None]


def test_paths_and_fingerprint(spark):
    assert one(spark, T.path_stem(F.lit("a/b.c/d.pdf")), T.path_stem(F.lit("a/.hidden")), T.mirrored(F.lit("/x/in/p/q.r/s.pdf"), "/x/in/", "/y")) == ["a/b.c/d", "a/.hidden", "/y/p/q.r/s"]
    assert one(spark, T.fingerprint(F.lit(10), F.timestamp_seconds(F.lit(5)))) == [hashlib.sha1(b"10:5").hexdigest()]


def test_json_and_header(spark):
    fenced = '```json\n{"k": 3}\n```'
    assert one(spark, T.unfenced_json(F.lit(fenced), "k int")["k"], T.unfenced_json(F.lit('{"k": 4}'), "k int")["k"], T.embedded_fingerprint(F.lit("a\n<!-- fingerprint=xy -->\nb"))) == [3, 4, "xy"]


def test_lists(spark):
    got = one(spark, T.scale_list(F.lit("0.5:1.0:0.25")), T.scale_list(F.lit("1, 2")), T.scale_list(F.lit("1:2:0")), T.comma_list(F.lit("a, ,b")), T.language_codes(F.array(F.lit("th"), F.lit("en"), F.lit("th"))))
    assert got == [[0.5, 0.75, 1.0], [1.0, 2.0], None, ["a", "b"], "tha+eng"]
    assert one(spark, T.parse_rect(F.lit("1,2,3")), T.env_flag(F.lit(" TRUE ")), T.env_flag(F.lit("0"))) == [None, True, False]


def test_boxes(spark):
    r = one(spark, T.clamp_box(F.lit(-5), F.lit(2), F.lit(10), F.lit(10), F.lit(8), F.lit(8)), T.crop_rect("norm", *(F.lit(v) for v in (0.25, 0.0, 0.5, 1.0, 100.0, 200.0))))
    assert tuple(r[0]) == (0, 2, 5, 6) and tuple(r[1]) == (25.0, 0.0, 50.0, 200.0)


def test_path_metadata(spark):
    more = (
        ("แพร่/เขตเลือกตั้งที่ 2/อ.สอง/ส.ส5-18/สส5-18แบ่งเขต ต.เตาปูน.pdf", "แพร่", 2, "สอง", "เตาปูน", "district", None, False),
        ("น่าน/เขตเลือกตั้งที่ 1/อำเภอเวียงสา/4.ทม.ไหล่น่าน/สส.แบบบัญชีรายชื่อ 5-18 (บช)/หน่วยที่ 8 ทม.ไหล่น่าน.pdf", "น่าน", 1, "เวียงสา", "ไหล่น่าน", "partylist", 8, False),
        ("พะเยา/เขตเลือกตั้งที่ 2/อ.จุน/สส.5-18 5-18(บช)/page.pdf", "พะเยา", 2, "จุน", None, "partylist", None, False),
        ("", None, None, None, None, None, None, False),
        ("data\\raw\\แพร่\\y.pdf", "แพร่", None, None, None, None, None, False),
        ("น่าน/อ.เมือง/ผาสิงห์ ชุดที่31.pdf", "น่าน", None, "เมือง", "ผาสิงห์", None, None, False),
    )
    rows = [*PATHS, *more]
    got = spark.createDataFrame([(r[0],) for r in rows], "p string").select(path_metadata(F.col("p")).alias("m")).select("m.*").collect()
    assert [tuple(g)[:7] for g in got] == [r[1:] for r in rows]
    assert [g.raw_path for g in got] == [r[0] for r in rows]
