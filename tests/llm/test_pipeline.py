import random
import zlib

import numpy as np
import public_tokenizers
from test_operators import exact_components
from tokenizers import Tokenizer

import corpus_pipeline
from voxloom.llm import common
from voxloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in left.select("doc_id").collect()}
        out = stage(spark, left, SF)
        assert out.columns == docs.columns
        after = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert after <= before
        if name != "near_duplicates":
            assert len(good & before - after) <= 0.02 * len(good)
        left = out
    pieces = corpus_pipeline.packing_stage(spark, left, SF).collect()
    assert {r["doc_id"] for r in pieces} == after
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in pieces)
    assert {r["doc_id"]: r["doc_tokens"] for r in corpus_pipeline.run(spark, SF).collect()} == {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert texts


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)


EXTRA = "doc_id long, text string, lang string, source string, n_chars long, host string, own double, said string, maybe boolean, ID long, quality double, band long, id_ string"
PLAIN = "The council met on Monday to speak about the new road, and the mayor said that work would begin soon. "


def written(spark, path, rows):
    """rows of (doc_id, text, lang, source) as documents with columns that clash with those inside, and labels for them."""
    spark.createDataFrame([(*r, len(r[1] or ""), "h", 0.5, "s", True, 7, 0.5, 1, "x") for r in rows], EXTRA.replace("ID long", "Id2 long")).write.parquet(f"{path}/documents.parquet")
    marks = [(i, int("!!" not in (t or "!!")), 0) for i, t, *_ in rows if i is not None]
    spark.createDataFrame([*marks, (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def chained(spark, sf_dir):
    """What every stage leaves, as text and id pairs, and the pieces of the last."""
    docs, left = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = common.staged(out, name)
        left.append([(r["doc_id"], r["text"]) for r in docs.collect()])
    return left, corpus_pipeline.packing_stage(spark, docs, sf_dir).collect()


def test_odd_documents_go_through_every_stage(spark, tmp_path):
    rng = random.Random(2)
    good = [(i, " ".join(rng.sample(PLAIN.split() * 4, 60)), "en", f"s{i % 3}.org/a") for i in range(80)]
    bad = [(100 + i, " ".join(w.upper() + "!!" for w in rng.sample(PLAIN.split() * 4, 60)), "en", "s1.org/b") for i in range(40)]
    long = [(200, " ".join(rng.choice(PLAIN.split()) for _ in range(50_000)), "en", "s1.org/a")]
    odd = [(300, None, "en", "s1.org/a"), (301, "", None, None), (302, "12 34 56", "en", ""), (None, good[0][1] + " again", "en", "s1.org/a"), (303, good[3][1], "en", None), (304, good[4][1] + " more", None, "s9.org"), (305, good[5][1].upper(), "en", "s0.org/a")]
    rows = good + bad + long + odd + [good[0], good[0], good[1]]
    left, pieces = chained(spark, written(spark, tmp_path, rows))
    quality_left, language_left, kept = left
    ids = lambda found: {i for i, _ in found}
    assert not ids(quality_left) & ids(bad_rows := [(r[0], r[1]) for r in bad]) and bad_rows
    assert {r[0] for r in good} | {200, 303, 304} <= ids(quality_left)
    assert len(quality_left) == sum(r[0] in ids(quality_left) for r in rows)  # rows that repeat stay until the third stage
    assert ids(quality_left) - ids(language_left) == ids(quality_left) & {300, 301, 302}
    alive = [(i, t) for i, t in set(language_left) if i is not None]
    want = exact_components(alive, 80)
    assert sorted(kept, key=str) == sorted([(i, t) for i, t in alive if want[i][2]] + [(i, t) for i, t in language_left if i is None], key=str)
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = {}
    for r in sorted(pieces, key=lambda r: r["start"]):
        parts.setdefault(r["doc_id"], []).extend(r["ids"])
    assert parts == {i: tk.encode(t, add_special_tokens=False).ids + [1] for i, t in kept}


def test_empty_and_unlabelled_documents_go_through_every_stage(spark, tmp_path):
    left, pieces = chained(spark, written(spark, tmp_path / "a", []))
    assert left == [[], [], []] and pieces == []
    path = str(tmp_path / "b")
    spark.createDataFrame([(1, PLAIN, None, None, 5), (2, None, None, None, 5)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    left, pieces = chained(spark, path)
    assert left[0] == [(1, PLAIN), (2, None)] or len(left[0]) == 2
    assert left[1:] == [[], []] and pieces == []  # no language was learned
