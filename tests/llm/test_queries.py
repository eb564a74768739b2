"""The registered queries against SQL where it can express them, and the pipeline."""

import corpus_pipeline
import pytest
from compare import connect, difference

from cubeloom.llm.common import table
from cubeloom.llm.queries import ORACLES, QUERIES
from cubeloom.session import materialize
from test_simhash import jaccard, plain_components, shingles


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op11_whitening"}))
def test_query_has_a_row_for_each_document(spark, sf_dir, name):
    n = table(spark, sf_dir, "documents").count()
    rows = QUERIES[name](spark, sf_dir)
    assert name == "op6_packing" or rows.count() == n


def test_whitening_has_four_rows_for_each_vector(spark, sf_dir):
    rows = QUERIES["op11_whitening"](spark, sf_dir)
    assert rows.count() == 4 * table(spark, sf_dir, "embeddings").count()
    assert rows.where("identity_error > 1e-9 OR whitened IS NULL OR deviation IS NULL").isEmpty()


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], sf_dir), name))
        if name != "bpe":
            assert seen[-1].columns == docs.columns
    _, clean, lines, near, mixed, encoded = seen
    assert lines.count() == clean.count() <= docs.count()
    rows = lines.select("doc_id", "text").collect()
    sets = [shingles(r.text or "") for r in rows]
    want = plain_components([r.doc_id for r in rows], lambda i, j: jaccard(sets[i], sets[j]) >= 0.8)
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(want))
    words = near.selectExpr("sum(size(split(trim(text), '\\\\s+')))").first()[0]
    taken = mixed.selectExpr("sum(size(split(trim(text), '\\\\s+')))").first()[0]
    assert 1.3 * words < taken < 1.6 * words
    assert encoded.count() == mixed.count()
    assert encoded.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
