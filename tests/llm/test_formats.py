import base64
import hashlib
import itertools
import random
import zlib
from array import array
from collections import Counter

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formloom.llm import chat_format, packing, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a", "<p>x</p>"), (2, "http://b\r\nX: y", "é" * 9), (3, None, None), (4, "u", ""), (5, "u", "<p>x</p>"), (6, "u", "z\r\n\r\nWARC/1.1\r\n" * 90_000), (7, "u", "<p>x</p>"), (None, "u", "lone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("frame", F.lit(1)).withColumn("bundle", F.lit("b"))
    folder = f"file://{tmp_path}/arc"
    index = warc.write_archives(pages, folder, frame_bytes=200, bundle_bytes=100)
    got = {r.page_id: r for r in warc.read_archives(index, folder, with_payload=True).collect()}
    first = {}
    for i, _, html in rows:
        payload = (html or "").encode()
        r, original = got[i], first.setdefault(payload, i)
        assert (r.payload_bytes, r.payload_digest) == (len(payload), digest(payload))
        assert (r.record_type, r.refers_to) == (("response", None) if original == i else ("revisit", original))
        assert r.payload == (payload if original == i else b"")
    wrong = index.withColumn("offset", F.when(F.col("page_id") == 4, F.col("offset") + 1).otherwise(F.col("offset")))
    with pytest.raises(Exception, match="no record at offset|subsection not found"):  # records are found by their offsets
        warc.read_archives(wrong, folder).count()
    with pytest.raises(Exception, match="revisit without its response"):
        warc.read_archives(index.where("page_id <> 1"), folder).collect()
    head, body = warc.fetch(index, folder, 2)[0]
    assert body == ("é" * 9).encode() and head["warc-type"] == "response"
    names = list((tmp_path / "arc").glob("*.warc.zst"))
    assert len(names) > 1
    for name in names:  # any reader takes a bundle as one stream
        with name.open("rb") as f:
            assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read().startswith(b"WARC/1.1")
    assert warc.read_archives(warc.write_archives(pages.limit(0), f"file://{tmp_path}/none"), f"file://{tmp_path}/none").count() == 0


def test_warc_repeated_ids_and_minimum(spark, tmp_path):
    pages = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "a"), (4, "a"), (4, "a")], "page_id long, html string")
    folder = f"file://{tmp_path}/arc"
    got = sorted((r.page_id, r.record_type) for r in warc.read_archives(warc.write_archives(pages, folder, url_column=None, min_bytes=2), folder).collect())
    assert got == [(1, "response"), (2, "revisit"), (3, "response"), (4, "response"), (4, "response")]


def test_warc_decides_by_id_and_payload(spark, tmp_path):
    rows = [(3, "X"), (5, "X"), (5, "Y"), (7, "Z"), (8, "V"), (9, "Z"), (9, "V"), (None, "X"), (None, "W"), (None, "T"), (None, "T")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    folder = f"file://{tmp_path}/arc"
    got = [(r.page_id, r.refers_to, r.payload) for r in warc.read_archives(warc.write_archives(pages, folder, url_column=None), folder, True).collect()]
    want = [(3, None, b"X"), (5, 3, b""), (5, None, b"Y"), (7, None, b"Z"), (8, None, b"V"), (9, 7, b""), (9, 8, b""), (None, 3, b""), (None, None, b"W"), (None, None, b"T"), (None, None, b"T")]
    assert sorted(got, key=str) == sorted(want, key=str)


def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


OWN = tokenizer()


def default_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


DEFAULT = default_tokenizer()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1.'s \n\t é!|<>endoftx_ñ")), max_size=20) | st.text(max_size=12))
def test_ids(text):
    assert packing.packed_ids(text, PATH) == array("I", OWN.encode(text, add_special_tokens=False).ids).tobytes()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", " b", "'s", "é", "12"]), max_size=12).map("".join))
def test_ids_with_added_tokens(text):
    assert packing.packed_ids("a <|endoftext|> b", PATH) == array("I", [64, 220, 50256, 275]).tobytes()
    assert packing.packed_ids(text, PATH) == array("I", DEFAULT.encode(text, add_special_tokens=False).ids).tobytes()


def test_packing_with_added_tokens(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    (got,) = packing.pack_documents(docs, PATH).collect()
    assert (got.doc_tokens, got.length, got.ids_crc32) == (5, 5, zlib.crc32(array("I", [64, 220, 50256, 275, 0]).tobytes()))


def brute_first_fit(sizes, length):
    bins, out = [], {}
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        b = next((b for b, used in enumerate(bins) if used + sizes[k] <= length), len(bins))
        if b == len(bins):
            bins.append(0)
        out[k] = (b, bins[b])
        bins[b] += sizes[k]
    return [out[k] for k in range(len(sizes))]


def test_first_fit_decreasing():
    rng = random.Random(6)
    for _ in range(200):
        sizes = [rng.randint(1, 16) for _ in range(rng.randint(1, 40))]
        assert packing.first_fit_decreasing(sizes, 16) == brute_first_fit(sizes, 16)


def test_packing(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(["word ", "é", "\n", "12 ", "x"]) for _ in range(rng.randint(0, 4000)))) for i in range(60)]
    rows += [(100, None), (101, ""), (100, None), (None, "a"), (102, "b " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit(1)).withColumn("start", F.lit(2))
    got = packing.pack_documents(docs, PATH, docs_per_group=20).collect()
    ids = {i: [*OWN.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    pieces, bins = {}, {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(array("I", part).tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, found in pieces.items():
        copies = 2 if i == 100 else 1
        assert sum(n for _, n in found) == copies * len(ids[i])
    for found in bins.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= 1024
    assert sum(len(v) for v in ids.values()) / (1024 * len(bins)) > 0.9
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def chats(spark, n=120):
    rng = random.Random(3)
    rows = []
    for c in range(n):
        role, t = ("system" if rng.random() < 0.4 else "user"), 0
        for t in range(rng.randint(2, 7)):
            size = {"system": 8, "user": 4, "assistant": 60}[role]
            rows.append((c, t, role, "User: hello" if role == "user" and rng.random() < 0.1 else "w " * rng.randint(size // 2, size)))
            role = "user" if role != "user" else "assistant"
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1)).withColumn("found", F.lit(0))


def test_roles(spark):
    df = chats(spark)
    got = chat_format.format_chats(df).collect()
    assert sum(r.role == r.found_role for r in got) / len(got) > 0.95 and len(got) == df.count()
    assert all(r.rendered.startswith(f"<|{r.found_role}|>\n") and "User:" not in r.rendered for r in got)


def turns_of(df):
    return chat_format.observed(df.select("conv_id", "turn", "text", "role"))


def test_ranges_give_the_whole_path(spark, monkeypatch):
    df = chats(spark, 60)
    model = chat_format.train(turns_of(df))
    long = df.withColumn("turn", F.col("conv_id") * 10 + F.col("turn")).withColumn("conv_id", F.lit(5))
    symbols = [r.symbol for r in turns_of(long).orderBy("turn").collect()]
    want = [chat_format.ROLES[k] for k in model.decode(symbols)]
    for size in (64, 4):  # the second makes a tree of ranges of ranges
        monkeypatch.setattr(chat_format, "RANGE", size)
        got = [r.found_role for r in sorted(chat_format.format_chats(long, model).collect(), key=lambda r: r.turn)]
        assert got == want


def test_decoding_is_the_best_of_all_paths(spark):
    model = chat_format.train(turns_of(chats(spark, 40)))
    rng = random.Random(11)
    for n in (1, 2, 3, 4, 5):
        symbols = [rng.randrange(chat_format.N_SYMBOLS) for _ in range(n)]

        def score(path):
            return model.first[path[0]] + sum(model.after[a, b] for a, b in itertools.pairwise(path)) + sum(model.seen[r, s] for r, s in zip(path, symbols, strict=True))

        best = max(itertools.product(range(len(chat_format.ROLES)), repeat=n), key=score)
        assert score(model.decode(symbols)) == pytest.approx(score(best))


def test_odd_turns(spark):
    df = chats(spark)
    model = chat_format.train(turns_of(df))
    rows = [(None, 0, None, "a"), (None, None, "user", None), (1, None, "x", ""), (1, 5, "x", "b"), (1, 5, "x", "b"), (2, 0, "user", "y" * 200_000)]
    odd = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert chat_format.format_chats(odd, model).count() == 6
    assert chat_format.format_chats(odd.limit(0), model).count() == 0


def test_transcripts(spark):
    df = chats(spark)
    model = chat_format.train(turns_of(df))
    raw = spark.createDataFrame([(1, "User: hi there\nhow are you\nAssistant: fine " + "w " * 50 + "\n\nthanks"), (2, None), (3, " \n ")], "doc_id long, text string")
    turns = chat_format.split_transcripts(raw)
    assert turns.count() == 3
    got = sorted(chat_format.format_chats(turns, model, role_column=None).collect(), key=lambda r: r.turn)
    assert [r.found_role for r in got] == ["user", "assistant", "user"]
    assert got[0].rendered == "<|user|>\nhi there\nhow are you\n<|end|>"


def test_parsed_conversations(spark):
    df = chats(spark, 200)
    raw = chat_format.raw_transcripts(df)
    assert 0.15 < raw.where("raw like '\n\n%'").count() / raw.count() < 0.35
    got = chat_format.parsed_conversations(df).collect()
    assert {(r.conv_id, r.turn) for r in got} == {(r.conv_id, r.turn) for r in df.collect()}
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and all(r.held_out == (zlib.crc32(str(r.conv_id).encode()) % 5 == 0) for r in got)
    assert sum(r.role == r.found_role for r in held) / len(held) > 0.95
    assert all(r.rendered.startswith(f"<|{r.found_role}|>\n") and r.rendered.endswith("\n<|end|>") for r in got)
    assert chat_format.parsed_conversations(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None, None, None), (1, 1, "user", ""), (1, 1, "user", ""), (2, None, "x", "a\n\nb")], "conv_id long, turn long, role string, text string")
    assert Counter(r.conv_id for r in chat_format.parsed_conversations(df.select(*odd.columns).where("conv_id > 5").union(odd)).collect() if r.conv_id is None or r.conv_id in (1, 2)) == {None: 1, 1: 2, 2: 2}
