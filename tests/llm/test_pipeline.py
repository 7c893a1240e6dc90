"""The pipeline against a plain version of each stage, on a small fixture with planted cases."""

import random

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402

from formloom.llm import decontaminate, near_dedup, packing, toxicity  # noqa: E402
from formloom.llm.queries import tokenizer_path  # noqa: E402


def fixture(spark, folder):
    rng = random.Random(1)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(500)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, line(rng.randint(20, 80))) for i in range(300)]
    labels = [(i, 0, 1) for i in range(0, 300, 2)]
    for i in range(300, 500):
        rows.append((i, line(30) + " vile nasty " + line(9)))
        labels.append((i, 1, 1))
    rows += [(600, rows[3][1]), (601, rows[3][1] + " tail"), (602, None), (603, "")]
    item = line(40)
    rows.append((604, line(20) + ". " + item.upper() + "! " + line(10)))
    spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, labels, item


def test_pipeline(spark, tmp_path):
    rows, labels, item = fixture(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    texts = dict(rows)
    model = toxicity.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    after = {i for i, t in rows if model.scores([t])[0] < 0.5}
    assert kept["toxicity"] == after and not after & set(range(300, 500)) and set(range(300)) <= after
    last = {}
    for i in sorted(after):
        last[texts[i] or ""] = i
    after = set(last.values())
    assert kept["exact dedup"] == after and 600 in after and 3 not in after and 602 not in after
    ids = sorted(after)
    bags = {i: near_dedup.bag(*near_dedup.shingles([texts[i] or ""]))[::2] for i in ids}
    gone = {b for b in ids for a in ids if a < b and len(bags[a][0]) and len(bags[b][0]) and near_dedup.overlap(bags[a], bags[b]) >= 0.8}
    assert kept["near dedup"] == after - gone and 601 in gone
    after -= gone
    block = decontaminate.ItemBlock([(1, item)])
    after = {i for i in after if not block.matches(decontaminate.plain(texts[i]))}
    assert kept["decontamination"] == after and 604 not in after
    assert kept["packing"] == after
    assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = {i: len(packing.packed_ids(texts[i] or "", tokenizer_path())) // 4 + 1 for i in after}
    assert sum(r.length for r in docs.collect()) == sum(whole.values())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_stages_on_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, names that the operators use themselves; then empty tables."""
    names = ["row", "score", "kept", "own_id", "text_sha256", "text_hash", "class_id", "length", "item_id", "node", "key"]
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "x"), (None, "x"), (None, None), (2, ""), (3, None), (4, "long " * 30_000)]
    docs = spark.createDataFrame([(*r, "s", "en", 1, *names) for r in rows], "doc_id long, text string, source string, lang string, n_chars int, " + ", ".join(f"{n} string" for n in names))
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    distinct = [(1, "a b c d e f"), (None, "x"), (3, None), (4, rows[-1][1])]
    for table, want in ((docs, (rows, distinct, distinct, distinct)), (docs.limit(0), ([],) * 4)):
        for (_, stage), kept in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
            got = stage(spark, table, str(tmp_path))
            assert got.columns == docs.columns
            found = got.collect()
            assert sorted(((r.doc_id, r.text or "", r.row) for r in found), key=str) == sorted(((i, t or "", "row") for i, t in kept), key=str)
            table = spark.createDataFrame(found, docs.schema)
        packed = corpus_pipeline.packing_stage(spark, table, str(tmp_path)).collect()
        assert {r.doc_id for r in packed} == {i for i, _ in want[-1]}
