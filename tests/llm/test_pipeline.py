"""The pipeline's stages against brute force, each on its own input."""

from pathlib import Path

import pytest
from brute import CLASHES, LONG, PROSE, SCHEMA, SECRET, SF, check_packing, empty, groups, odd, secrets, shipped, without_repeats  # noqa: F401

import corpus_pipeline
from __spark_entry__ import queries

pytestmark = pytest.mark.usefixtures("shipped")
STAGES = dict(corpus_pipeline.STAGES)


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeats", "secrets", "packing"]
    assert queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")
def test_pipeline_over_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = sorted(((r.doc_id, r.text or "") for r in docs.collect()))
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "language":
            assert len(after) >= 0.97 * len(before)
        elif name == "near_duplicates":
            tops = groups([t for _, t in before], 5, 80)
            assert set(after) == {before[t][0] for t in tops}
        elif name == "repeats":
            for (i, text), (words, gone) in zip(before, without_repeats([t for _, t in before])):
                if all(gone):
                    assert i not in after
                else:
                    assert after[i] == (b" ".join(w for w, g in zip(words, gone) if not g).decode() if any(gone) else text)
        else:
            assert set(after) == {i for i, _ in before}
            for i, text in before:
                assert (after[i] != text) == bool(secrets(text))
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_packing(STAGES["packing"](spark, docs, SF).collect(), texts)


def test_stages_on_odd_texts(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        assert stage(spark, empty(odd), SF).count() == 0
        if name == "packing":
            continue
        assert out.columns == odd.columns
        found = out.collect()
        assert all(r.label == "x" and r.kept == "x" for r in found)
        if name == "language":
            assert {3, 4, 5, 10}.isdisjoint({r.doc_id for r in found})
        if name == "near_duplicates":
            # Copies, a repeated row and one with a null id form one group; ONE and one are equal in lower case.
            assert sorted(r.doc_id for r in found) == [1, 3, 4, 5, 6, 7, 8, 10, 11]
        if name == "repeats":
            assert 2 not in {r.doc_id for r in found} and {1, 3, 4, 5, 6, 7, 8} & {r.doc_id for r in found}
        if name == "secrets":
            assert len(found) == 14 and all(r.text == t for r, t in zip(found, [PROSE]) if r.doc_id == 1)


def test_documents_without_languages_stay(spark, frame):
    docs = frame("doc_id long, text string, lang string, source string, n_chars long", (1, "some words here", None, None, None))
    assert STAGES["language"](spark, docs, SF).count() == 1
