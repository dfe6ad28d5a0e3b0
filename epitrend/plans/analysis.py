"""Clean table -> the analysis's answers (stages 2 to 4).

``analyze`` returns lazily built DataFrames keyed by question; only the
clustering results are computed eagerly (model fits are iterative jobs)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from epitrend import operators as op
from epitrend.config import (BANDS, BASELINE, COMPARE_WITH, KMEANS_K, REFIT_K, SEED,
                             SWEEP_KS, TOP_K, TRAIN_RATIO)

MEASURE_NAMES = ("Active", "Confirmed", "Deaths", "Recovered")


def snapshot_reports(clean: DataFrame, k: int = TOP_K,
                     on: str | dt.date | None = None) -> dict[str, DataFrame]:
    """Snapshot and the top / bottom k per measure, at the latest date or at
    date ``on`` (the date selector of the dashboard)."""
    snap = op.latest_snapshot(clean) if on is None else op.as_of_snapshot(clean, on)
    out = {"snapshot": snap}
    for m in MEASURE_NAMES:
        out[f"top_bottom_{m.lower()}"] = op.top_bottom(snap, m, k)
    return out


def feature_reports(clean: DataFrame, bands: Sequence[tuple[float, float]] = BANDS,
                    baseline: str = BASELINE, k: int = TOP_K,
                    compare_with: Sequence[str] = COMPARE_WITH) -> dict[str, DataFrame]:
    """Feature table, differences to the baseline, most similar / different,
    and the curves of the baseline next to each chosen entity."""
    feats = op.feature_table(clean, bands)
    diffs = op.baseline_diff(feats, baseline, op.band_columns(bands))
    out = {
        "features": feats,
        "features_long": op.unpivot_features(feats, op.band_columns(bands)),
        "diffs": diffs,
        "similar_by_abs": op.similar_entities(diffs, "abs", k),
        "similar_by_rel": op.similar_entities(diffs, "rel", k),
    }
    for other in compare_with:
        out[f"curves_{other}"] = op.compare_curves(clean, baseline, other)
    return out


def cluster_reports(features: DataFrame, cols: Sequence[str], k: int = KMEANS_K,
                    refit_k: int | None = REFIT_K, ks: Sequence[int] = SWEEP_KS,
                    ratio: float = TRAIN_RATIO, seed: int = SEED) -> dict[str, object]:
    """Split, fit k, score, sweep ks, refit (``refit_k=None``: the sweep's
    best silhouette). The assembled features are stored once in the fits'
    layout; every fit and score rereads them, not the plan behind them."""
    assembled = op.materialize(op.canonical_layout(op.materialize(op.assemble_features(features, cols))))
    train, test = op.train_test(assembled, ratio, seed)
    model = op.kmeans_fit(train, k, seed)
    pred = op.kmeans_assign(model, test)
    sweep = op.k_sweep(train, test, ks, seed)
    chosen = refit_k if refit_k is not None else (op.best_k(sweep) or k)
    refit = op.kmeans_fit(train, chosen, seed)
    refit_pred = op.kmeans_assign(refit, test)
    return {
        "model": model, "predictions": pred, "silhouette": op.silhouette(pred),
        "sweep": sweep, "refit_k": chosen, "refit_model": refit,
        "refit_predictions": refit_pred, "refit_silhouette": op.silhouette(refit_pred),
        "all_assignments": op.kmeans_assign(refit, assembled),
    }
