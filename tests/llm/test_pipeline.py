"""The pipeline's stages on odd rows, and the registered queries on the smallest tables."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tellerframe.llm import registry
from tellerframe.sources import storage
from tests.check_oracles import connect, differences

from . import plain

SMALL = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(odd_docs, odd_labels, odd_items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    for name, df in (("documents", odd_docs), ("labels", odd_labels), ("benchmark", odd_items)):
        df.write.parquet(f"{path}/{name}.parquet")
    return path


def test_stages_keep_the_columns(spark, folder, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), "stage")
        assert docs.columns == odd_docs.columns, name
        assert dict(docs.dtypes)["text"] == "string"


def test_quality_stage_follows_the_predictions(spark, folder, odd_docs, odd_labels):
    from tellerframe.llm import quality_classifier

    kept = Counter(r.doc_id for r in STAGES["quality classifier"](spark, odd_docs, folder).collect())
    assert kept == Counter(r.doc_id for r in quality_classifier.predicted_quality(odd_docs, odd_labels).where("predicted = 1").collect())


def test_near_duplicates_leave_one_of_each_group(spark, folder, odd_docs, odd_rows):
    """Rows without doc_id are compared too, and another text of a repeated doc_id stays."""
    rows = [(r[0], r[1]) for r in odd_rows[0]]
    group = {n: c for n, _, c in plain.jaccard_components([(n, text) for n, (_, text) in enumerate(rows)])}
    members = {}
    for n, row in enumerate(rows):
        members.setdefault(group[n], []).append(row)
    kept = Counter((r.doc_id, r.text) for r in STAGES["n-gram Jaccard join"](spark, odd_docs, folder).collect())
    assert sum(kept.values()) == len(members)
    left = kept.copy()
    for own in members.values():
        stays = [row for row in own if left[row] > 0]
        assert stays
        left[stays[0]] -= 1
    assert sum(1 for doc, _ in kept if doc == 601) == 2


def test_near_duplicates_leave_no_tables_of_the_search(spark, folder, odd_docs, tmp_path):
    """Later stages find the keyed rows and the removed keys on disk, no sets, postings or pairs."""
    path = f"{tmp_path}/work"
    before = storage._WORKING.set(path)
    try:
        left = STAGES["n-gram Jaccard join"](spark, odd_docs, folder)
        assert sorted(p.name.rsplit("-", 1)[0] for p in (tmp_path / "work").iterdir()) == ["keyed-rows", "near-duplicates"]
        assert 0 < left.count() < odd_docs.count()
    finally:
        storage._WORKING.reset(before)


def test_mixed_rows_are_sorted(spark, folder, odd_docs):
    rows = STAGES["mixing sources to target weights"](spark, odd_docs, folder).collect()
    first = [r.copies[0].position for r in rows]
    assert first == sorted(first) and all(r.taken == sum(c.words for c in r.copies) > 0 for r in rows)


def test_run_on_no_documents(spark, none, odd_labels, odd_items, tmp_path):
    for name, df in (("documents", none), ("labels", odd_labels), ("benchmark", odd_items)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", registry.QUERIES)
def test_queries(spark, name):
    df = contract.queries()[name](spark, SMALL)
    if name in registry.ORACLES:
        assert differences(df, connect(SMALL), contract.oracle_sql()[name]) == []
    else:
        assert {"doc_id", "vec_id", "conv_id"} & set(df.columns) and df.count() > 0


def test_all_thirteen_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()
    assert all(isinstance(sql, str) for sql in contract.oracle_sql().values())
