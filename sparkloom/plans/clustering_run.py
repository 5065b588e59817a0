"""Full clustering run and comparison of three clusterings."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.checks import check_k_range, require_feature_quality, require_small_loss, select_features
from sparkloom.operators.encode import decode_anonymised, fit_transform
from sparkloom.operators.linkage import history, require_history, single_linkage, spanning_tree
from sparkloom.operators.privacy import anonymise
from sparkloom.operators.profile import column_profile, default_spec
from sparkloom.operators.quality import agreement
from sparkloom.operators.selection import select_features as search_features
from sparkloom.session import cut
from sparkloom.sources.reuse import materialise_if_stale
from sparkloom.sources.runs import run_stamp, write_metadata, write_results
from sparkloom.sources.spec import TableSpec


def prepared(df: DataFrame, row_id: str, spec: TableSpec | None = None, folder: str | None = None) -> DataFrame:
    """Profile, default specification, encode; stored for reuse when a folder is given."""
    body = df.drop(row_id) if spec is None else df
    spec = spec or default_spec(column_profile(body))
    def build(source: DataFrame, s: TableSpec) -> DataFrame:
        return fit_transform(source, s, row_id)[0]
    out = materialise_if_stale(df, spec, folder, build) if folder else cut(build(df, spec))
    require_small_loss(df, out)
    return out


@dataclass
class Run:
    run_id: str
    features: list[str]
    labels: DataFrame
    results_path: str
    metadata_path: str


def full_run(df: DataFrame, folder: str, min_k: int, max_k: int, metric: str = "chebyshev", row_id: str = "row_id",
             spec: TableSpec | None = None, features: list[str] | None = None, max_iterations: int = 1000,
             seed: int = 42) -> Run:
    """Validate, encode, choose two features, cluster for every K, store results and metadata."""
    check_k_range(min_k, max_k, metric)
    started = datetime.now(timezone.utc)
    table = prepared(df, row_id, spec)
    columns = [c for c in table.columns if c != row_id]
    if features is None:
        # the two features are always chosen with the Chebyshev distance
        features = search_features(table, columns, 2, metric="chebyshev", row_id=row_id,
                                   max_iterations=max_iterations, seed=seed).features
    if len(features) != 2:
        raise ValueError(f"two features are needed, got {features}")
    require_feature_quality(table, features)
    chosen = cut(select_features(table, features, row_id))
    tree, ids, n = spanning_tree(chosen, features, metric, row_id)
    labels = cut(history(tree, ids, n, min_k, max_k))
    ks = [r["k"] for r in labels.select("k").distinct().collect()]  # one row per K
    expected = min(max_k, n) - min_k + 1
    require_history(labels, n, expected)
    run_id = run_stamp(started)
    path = write_results(chosen, labels, ks, folder, run_id, row_id)
    ended = datetime.now(timezone.utc)
    meta = {"run_id": run_id, "start_time": started.isoformat(), "end_time": ended.isoformat(),
            "duration_seconds": (ended - started).total_seconds(), "min_clusters": min_k, "max_clusters": max_k,
            "metric": metric, "row_count": n, "feature_count": len(features), "features": features,
            "k_values": sorted(ks, reverse=True), "expected_k_count": expected, "actual_k_count": len(ks),
            "merges": n - min_k}
    return Run(run_id, features, labels, path, write_metadata(df.sparkSession, folder, meta))


def anonymise_and_cluster(df: DataFrame, qis: list[str], k: int = 3, n_features: int | None = None,
                          metric: str = "euclidean", level: str = "moderate", row_id: str = "row_id",
                          identifiers: tuple[str, ...] = (), max_iterations: int = 1000, seed: int = 42) -> DataFrame:
    """(row_id, label) of the anonymised table; suppressed rows are absent."""
    safe = cut(decode_anonymised(anonymise(df, qis, level), row_id, identifiers))
    columns = [c for c in safe.columns if c != row_id]
    if n_features is not None and n_features < len(columns):
        columns = search_features(safe, columns, n_features, k, metric, row_id, max_iterations, seed).features
    return single_linkage(safe, columns, k, metric, row_id)


def compare_clusterings(df: DataFrame, qis: list[str], k: int = 3, n_features: int = 5, metric: str = "euclidean",
                        level: str = "moderate", row_id: str = "row_id", identifiers: tuple[str, ...] = (),
                        spec: TableSpec | None = None, max_iterations: int = 1000, seed: int = 42) -> DataFrame:
    """(comparison, rows, fm): all features, chosen features and anonymised data, pairwise on shared rows."""
    table = prepared(df.drop(*identifiers), row_id, spec)
    columns = [c for c in table.columns if c != row_id]
    chosen = search_features(table, columns, n_features, k, metric, row_id, max_iterations, seed).features
    every = cut(single_linkage(table, columns, k, metric, row_id))
    few = cut(single_linkage(table, chosen, k, metric, row_id))
    anon = cut(anonymise_and_cluster(df, qis, k, n_features, metric, level, row_id, identifiers, max_iterations, seed))
    out = None
    for name, a, b in (("preprocessing_vs_features", every, few), ("preprocessing_vs_anonymised", every, anon),
                       ("features_vs_anonymised", few, anon)):
        one = agreement(a, b).select(F.lit(name).alias("comparison"), "rows", "fm")
        out = one if out is None else out.unionByName(one)
    return out
