"""The pipeline, stage by stage, against brute force on the small tables."""

import numpy as np
import public_tokenizers
import pytest
from test_near_duplicates import groups, slow_fingerprint
from test_repeats import brute
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SMALL
from txscore.llm import toxicity
from txscore.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def after(spark, docs, sf_dir, tmp_path, stage):
    for name, f in corpus_pipeline.STAGES[:stage]:
        f(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    return docs


def test_stages_equal_brute_force(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    model = toxicity.fit(docs, table(spark, SMALL, "labels"), usable=toxicity.fold() != 0)
    want = {r.doc_id: r for r in docs.collect() if model.score(r.text) < 0.5}
    now = after(spark, docs, SMALL, f"{tmp_path}/a", 1)
    assert now.columns == COLUMNS
    assert {r.doc_id: r for r in now.collect()} == want and 0 < len(want) < docs.count()

    ids = sorted(want)
    fps = [slow_fingerprint(want[i].text) for i in ids]
    comp = groups(len(ids), [[j for j, g in enumerate(fps) if (f ^ g).bit_count() <= 3] for f in fps])
    want = {ids[c]: want[ids[c]] for c in set(comp)}
    now = after(spark, docs, SMALL, f"{tmp_path}/b", 2)
    assert now.columns == COLUMNS
    assert {r.doc_id: r for r in now.collect()} == want and len(want) < len(ids)

    ids = sorted(want)
    texts = {i: kept.decode("utf-8", "ignore") for i, (*_, kept) in zip(
        ids, brute([want[i].text for i in ids], 200), strict=True)}
    now = after(spark, docs, SMALL, f"{tmp_path}/c", 3)
    assert now.columns == COLUMNS
    got = {r.doc_id: r for r in now.collect()}
    assert {i: r.text for i, r in got.items()} == texts
    assert all((r.lang, r.source) == (want[i].lang, want[i].source) and r.n_chars == len(texts[i])
               for i, r in got.items())

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert sorted(pieces) == ids
    import zlib
    for i, parts in pieces.items():
        ids = np.array([*slow.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        assert sum(p[1] for p in parts) == len(ids) and all(p[3] == len(ids) for p in parts)
        for start, n, crc, _ in parts:
            assert zlib.crc32(ids[start:start + n].tobytes()) == crc


@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_stage_takes_nulls_clashing_columns_and_empty_tables(spark, stage):
    name, f = corpus_pipeline.STAGES[stage]
    rows = [(1, "some words here", None, "s", 15, 7, "x"), (None, "other text, quite another one", "en", None, None, 7, "x"),
            (2, None, "en", "s", 0, 7, "x"), (3, "", "en", "s", 0, 7, "x"), (1, "some words here", None, "s", 15, 7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "fp long, data string")
    got = f(spark, docs, SMALL)
    assert f(spark, docs.limit(0), SMALL).count() == 0
    if name == "packing":
        assert got.select("doc_id").distinct().count() == 4
    else:
        assert got.columns == docs.columns
        found = got.collect()
        assert len(found) == (3 if name == "simhash" else 5)
        if name != "simhash":
            assert [r.text for r in found if r.doc_id == 2] == [None]
        assert all(r.fp == 7 and r.data == "x" for r in found)
