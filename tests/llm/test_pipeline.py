"""The pipeline stage by stage, on hand-made rows and on the smallest tables."""

import os
import re

import corpus_pipeline as C
from corpusgrid.llm import pii
from corpusgrid.session import materialise
from tests.llm.test_lines_chat import brute_lines

SF = "/root/testdata/sf0.001"


def test_stages_on_odd_rows(spark):
    en = "the and of that with for this from have was not are but they which "
    shared = "this licence line stands in more than five of the documents here"
    rows = [(i, f"{en} number{i} own{i} words{i} of{i} text{i} " * 6 + "\n" + shared, "en") for i in range(12)]
    rows += [(50, rows[0][1] + " end", None), (51, rows[1][1], "en"), (1, rows[1][1], "en"), (60, None, "en"), (61, "", "en"), (62, "12 34", None),
             (63, en * 3 + "mail joe@mail.example.com now", "en"), (None, en + "row without an id", "en")]
    clash = ["keep", "lang_pred", "spans", "h1", "row", "tag", "length"]
    docs = spark.createDataFrame([(*r, "src", 1, *range(7)) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in clash))
    columns = docs.columns

    known = materialise(C.language_id(spark, docs, SF), "t1")
    assert known.columns == columns and {r.doc_id for r in known.collect()} == {r[0] for r in rows} - {60, 61, 62}
    lines = materialise(C.line_dedup(spark, known, SF), "t2")
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in lines.collect()), key=repr)
    assert got == sorted(((i, t, len(t)) for i, _, _, t in brute_lines([(r.doc_id, r.text) for r in known.collect()])), key=repr)
    assert lines.columns == columns
    near = materialise(C.near_dedup(spark, lines, SF), "t3")
    assert near.columns == columns and sorted(-1 if r.doc_id is None else r.doc_id for r in near.collect()) == [-1, *range(12), 63]
    clean = materialise(C.pii(spark, near, SF), "t4")
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert clean.columns == columns and texts[63] == (en * 3 + "mail [EMAIL] now", len(en * 3 + "mail [EMAIL] now"))
    assert all(texts[r.doc_id][0] == r.text for r in near.collect() if r.doc_id != 63)
    packed = C.packing(spark, clean, SF).collect()
    assert {r.doc_id for r in packed} == set(texts)
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_run_on_the_smallest_tables(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    packed = C.run(spark, SF).collect()
    left = {r.doc_id for r in packed}
    assert left <= set(docs) and len(left) >= 0.7 * len(docs)
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    assert any(pii.base_spans(t) for t in docs.values())


def test_names_of_stages():
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "near_dedup", "pii", "packing"]
    assert not re.search("except", open(os.path.abspath(C.__file__)).read())
