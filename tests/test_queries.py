"""Every query against its SQL twin."""

import os

import pytest

from reviewloom.queries import oracle_sql, queries
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Queries without SQL train iteratively.
TRAINED = {"lr_train", "automl_leaderboard", "automl_languages"}
# These take the ways for large tables: sorted places, hot keys, distributed quotas.
LARGE_PATHS = (
    "stratified_split", "stratified_sample_n", "encode_labels", "decode_labels", "token_ids", "nb_predict",
    "score_batch", "run_tree", "retire_old_versions", "bandit_terminate", "target_list", "vocab_build",
)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_only_trained_queries_lack_sql():
    assert set(queries()) - set(oracle_sql()) == TRAINED
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    problems, rows, _ = compare(spark, con, name, SF_DIR)
    assert not problems
    assert rows > 0 or name == "unseen_labels"


@pytest.mark.parametrize("name", LARGE_PATHS)
def test_query_on_large_path(spark, con, tiny_limits, name):
    problems, _, _ = compare(spark, con, name, SF_DIR)
    assert not problems
