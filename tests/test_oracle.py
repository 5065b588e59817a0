"""Registered queries against their SQL twins; every one with SPARKLOOM_ALL=1, a cross-section otherwise."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SECTION = ("numeric_projection null_report feature_quality column_profile entropy iqr_outliers encode_label "
           "fit_transform k_classes k_report generalise_numeric suppress_rare inject_random inject_block fill_regression fm_index "
           "nation_edges greedy_tours walk_step stored_results csv_documents csv_bad_values reusable_table column_kinds merge_log "
           "two_opt_best kmeans_rounds cluster_stats_full default_k feature_names input_check scale_none random_edges "
           "transition_weights linkage_history silhouette_sampled profile_merged").split()
NAMES = [n for n in entry.queries() if n in SECTION or os.environ.get("SPARKLOOM_ALL")]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, con, name):
    ok, message = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), sf)
    assert ok, message


def test_every_sql_has_a_query_and_the_flagship_runs(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 1
