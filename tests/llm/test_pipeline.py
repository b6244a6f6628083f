"""The pipeline: stages in order, each on what the one before kept."""

from __future__ import annotations

from pathlib import Path

import corpus_pipeline
import pytest
from test_texts import check_packed

import __spark_entry__ as contract
from purchaseflow.llm import queries


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.staged(stage(spark, out[-1], sf_dir), name))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language",
        "line_dedup",
        "near_duplicates",
        "pii",
        "packing",
    ]
    for before, after in zip(stages, stages[1:-1], strict=False):
        assert after.columns == before.columns
        assert 0 < after.count() <= before.count()
        assert after.select("doc_id").subtract(before.select("doc_id")).isEmpty()


def test_last_stage_packs_what_the_others_kept(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[-2].collect()}
    assert check_packed(stages[-1].collect(), texts) > 0.9


def test_run_of_odd_rows_and_of_an_empty_table(spark, odd, none, tmp_path):
    for name, docs in (("odd", odd), ("none", none)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r["doc_id"] for r in found} == ({None, 5, 6, 8, 9} if name == "odd" else set())


def test_no_run_of_fifty_words_is_left_that_stood_before(stages):
    """Brute force over the line stage: runs of words in the order of documents."""
    seen = set()
    for row in sorted(stages[2].collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        words = (row["text"] or "").split()
        own = {tuple(words[i : i + 50]) for i in range(len(words) - 49)}
        assert not own & seen
        seen |= own


def test_personal_data_is_gone_and_near_copies_too(stages):
    assert stages[-2].filter("text rlike '[a-z0-9]@[a-z0-9]+[.](example|com)'").isEmpty()
    left = [r["text"] for r in stages[3].collect()]
    assert len(left) == len(set(left))


def test_run_is_registered_and_whole(spark, sf_dir, stages):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    found = contract.queries()["pipeline"](spark, sf_dir)
    assert found.count() == stages[-1].count()
    # of all it has written, its result alone is left
    (left,) = set(shared.iterdir()) - before
    assert "stage-packing" in left.name
    assert set(queries.queries()) < set(contract.queries())
    assert sorted(n.split("_")[0] for n in queries.queries()) == sorted(
        f"op{i}" for i in range(1, 14)
    )
