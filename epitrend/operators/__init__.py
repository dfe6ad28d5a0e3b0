"""The analysis operators: each is a function DataFrame -> DataFrame."""

from epitrend.operators.band_state import (band_states, extend_band_state, finish_band_states,
                                           merge_band_states, read_band_state)
from epitrend.operators.cluster import (assemble_features, best_k, canonical_layout, center_facts,
                                        chord_distances, elbow_k, hash_split, k_sweep, kmeans_assign, kmeans_fit,
                                        label_facts, layout_partitions, materialize, n_centers,
                                        silhouette, silhouette_direct, train_test)
from epitrend.operators.compare import (aligned_curves, baseline_diff, compare_curves, curve_distances, similar_entities,
                                        transpose_features, unpivot_features)
from epitrend.operators.features import (array_index, band_columns, days_in_bands,
                                         feature_table, first_crossing, first_day,
                                         next_value, positive_rows, series_list)
from epitrend.operators.geo import country_codes, iso_aliases, rename_entities
from epitrend.operators.ingest import (coerce_measures, dated_partials, detect_dates, finish_partials,
                                       merge_partials, normalize_headers, rejected_dates,
                                       rejected_rows, report_partials, resolve_header, sum_dated)
from epitrend.operators.matching import approximate_codes, match_names
from epitrend.operators.neighbours import compared_pairs, nearest_entities
from epitrend.operators.profile import (fall_states, finish_profile, merge_falls, merge_profiles,
                                        profile_partials)
from epitrend.operators.rollup import daily_rollup, qualify_entities
from epitrend.operators.snapshot import as_of_snapshot, latest_snapshot, top_bottom, value_as_of

__all__ = [
    "aligned_curves", "approximate_codes", "array_index", "as_of_snapshot", "assemble_features",
    "band_columns", "band_states", "baseline_diff", "best_k", "canonical_layout", "center_facts",
    "chord_distances", "coerce_measures", "compare_curves", "compared_pairs", "country_codes",
    "curve_distances", "daily_rollup", "dated_partials", "days_in_bands", "detect_dates", "elbow_k",
    "extend_band_state", "fall_states", "feature_table", "finish_band_states", "finish_partials",
    "finish_profile", "first_crossing", "first_day", "hash_split", "iso_aliases", "k_sweep", "kmeans_assign",
    "kmeans_fit", "label_facts", "latest_snapshot", "layout_partitions", "match_names", "materialize",
    "merge_band_states", "merge_falls", "merge_partials", "merge_profiles", "n_centers", "nearest_entities",
    "next_value", "normalize_headers", "positive_rows", "profile_partials", "qualify_entities",
    "read_band_state", "rejected_dates", "rejected_rows", "rename_entities", "report_partials",
    "resolve_header", "series_list", "silhouette", "silhouette_direct", "similar_entities", "sum_dated",
    "top_bottom", "train_test", "transpose_features", "unpivot_features", "value_as_of",
]
