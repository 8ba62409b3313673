"""pitfeat: point-in-time-correct feature tables and training sets on Spark."""

from .operators.lookup import (AsOfRight, asof_point_features, lookup_asof, lookup_exact, lookup_interval,
                               restrict_to_spine_keys)
from .operators.quality import (null_counts, orphans, validate_not_null, validate_spec, validate_unique,
                                validate_versions)
from .operators.reshape import flatten_array, request_struct
from .operators.rolling import (aggregate_features, daily_partials, daily_totals, dense_daily, from_partials,
                                point_features)
from .operators.scd import build_scd2, latest_snapshot
from .plans.client import FeatureClient
from .plans.inspect import plan_report
from .plans.ml import fit_tree, score_batch, score_supplied, select_features, split
from .plans.training import FeatureTable, apply_spec, attach, compile_features, training_set
from .session import cluster_profile, ensure_checkpoint_dir, get_spark, materialize
from .specs import (Agg, AggregateSpec, FeatureAggregation, FeatureFunction, FeatureLookup, FeatureSpec,
                    Lookback, TableSpec, expand_search_space)

__all__ = [
    "Agg", "AggregateSpec", "AsOfRight", "FeatureAggregation", "FeatureClient", "FeatureFunction",
    "FeatureLookup",
    "FeatureSpec", "FeatureTable", "Lookback", "TableSpec", "aggregate_features", "apply_spec",
    "attach", "build_scd2", "cluster_profile", "compile_features", "daily_partials", "daily_totals",
    "dense_daily", "ensure_checkpoint_dir", "expand_search_space", "fit_tree", "flatten_array",
    "get_spark", "latest_snapshot", "lookup_asof", "lookup_exact", "lookup_interval", "materialize",
    "null_counts", "orphans", "request_struct", "score_batch", "score_supplied", "select_features",
    "split", "training_set", "validate_not_null", "validate_spec", "validate_unique",
    "asof_point_features", "restrict_to_spine_keys", "validate_versions", "from_partials", "point_features",
    "plan_report",
]
