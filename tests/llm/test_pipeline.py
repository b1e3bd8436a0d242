"""The pipeline against a plain run of its stages' contracts on a small table."""

from __future__ import annotations

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from careledger.llm import common, quality, tokens
from test_operators import SF, brute_components


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    cur, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        cur = common.stored(stage(spark, cur, SF), "test")
        assert cur.columns == columns
        seen.append(cur.collect())
    good, one, clean, mixed = seen
    scores = {r.doc_id: r.predicted for r in quality.op10_quality_classifier(spark, SF).collect()}
    assert {r.doc_id for r in good} == {d for d, p in scores.items() if p}
    groups = brute_components([(r.doc_id, r.text) for r in good])
    assert {r.doc_id for r in one} == {d for d, c in groups.items() if d == c}
    assert {r.doc_id for r in clean} == {r.doc_id for r in one} and all(r.n_chars == len(r.text) for r in clean)
    texts = {r.doc_id: r.text for r in clean}
    assert all(texts[r.doc_id] == r.text for r in mixed)
    out = corpus_pipeline.run(spark, SF).toPandas()
    t = Tokenizer.from_file(tokens.tokenizer_path("byte_bpe_50k.json"))
    want = sorted(t.encode(r.text, add_special_tokens=False).ids + [0] for r in mixed)
    assert sum(map(len, want)) == out.length.sum()
    assert sorted(np.concatenate(want).tolist()) == sorted(np.concatenate(out.ids.tolist()).tolist())


KIND = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)
LONG = [f"word{i} of a longer text that is here" for i in range(40)]


def folder(spark, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def table(spark, rows):
    """Rows (doc_id, text) with the columns of documents and some that helpers of the operators are called, or were."""
    docs = spark.createDataFrame([(i, t, "en", "s" if k % 2 else None, None if t is None else len(t)) for k, (i, t) in enumerate(rows)], KIND)
    names = ["__id", "__marks", "dedup_spans", "mix_target", "mix_size", "__at", "__copy", "s_words", "node", "row", "component_id", "ids"]
    return docs.selectExpr("*", *[f"{k} AS `{n}`" for k, n in enumerate(names)])


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


ODD_ROWS = [(None, "a null id"), (None, "a null id"), (1, None), (2, ""), (3, "  \n"), (4, "one two three"), (4, "one two three"), (5, "x" * 3000), (6, "long " * 9000)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_every_stage_takes_odd_rows(spark, tmp_path, name):
    sf = folder(spark, tmp_path, [(1, 0, 0), (None, 1, 0), (2, None, 0)])
    docs = table(spark, ODD_ROWS)
    out = STAGE[name](spark, docs, sf)
    if name != "packing":
        assert out.dtypes == docs.dtypes
    assert out.count() > 0
    assert STAGE[name](spark, docs.where("doc_id > 99"), sf).count() == 0
    if name in ("quality_classifier", "substring_dedup"):
        assert [r[0] for r in pairs(out)] == [r[0] for r in sorted(ODD_ROWS, key=str)]
    if name == "jaccard_join":
        assert pairs(out) == sorted([(None, "a null id")] * 2 + ODD_ROWS[2:6] + ODD_ROWS[7:], key=str)


@pytest.mark.parametrize("labels", [[], [(i, 1, 0) for i in range(40)], [(i, 0, 0) for i in range(40)], [(i, None, 0) for i in range(40)]])
def test_all_stay_where_no_classifier_can_be_learnt(spark, tmp_path, labels):
    docs = table(spark, list(enumerate(LONG)))
    assert STAGE["quality_classifier"](spark, docs, folder(spark, tmp_path, labels)).count() == 40


def test_copies_go_by_their_own_text_where_ids_repeat(spark, tmp_path):
    a, b, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abd")
    e = " ".join(f"e{i}" for i in range(30))
    rows = [(1, a), (2, a), (2, b), (2, e), (3, d), (3, d), (3, ""), (4, d.upper()), (5, b + " more")]
    got = pairs(STAGE["jaccard_join"](spark, table(spark, rows), str(tmp_path)))
    assert got == sorted([(1, a), (2, b), (2, e), (3, d), (3, "")], key=str)
    hot = [(7, a)] * 500 + [(8, a + " again")] * 300 + [(9, b)]
    assert pairs(STAGE["jaccard_join"](spark, table(spark, hot), str(tmp_path))) == sorted([(7, a), (9, b)], key=str)
