"""Operators on DataFrames. Those that learn from data are Spark ML estimators."""

from tabwright.operators.clean import (
    DropSparse, add_null, cast_numeric, drop_columns, invalidate, rename, require, select_at,
)
from tabwright.operators.counted import CountedForest
from tabwright.operators.encode import TargetEncode
from tabwright.operators.extract import by_class, class_items, list_items, list_tail, page_lists, table_rows
from tabwright.operators.impute import Impute
from tabwright.operators.reference import band_lookup, key_grid, lookup, prob_impute, rate_grid
from tabwright.operators.kernel import NystroemFeatures, NystroemModel
from tabwright.operators.ovr import MOST_LABELS, OneAgainstRest, OneAgainstRestModel
from tabwright.operators.metrics import (
    best_model, binary_metrics, compare_models, fold_accuracy, mean_fold_accuracy, metrics_long, roc_auc, route, stack,
    weighted_metrics,
)
from tabwright.operators.profile import (
    cardinality_profile, column_modes, missing_profile, numeric_profile, row_count, skew_profile, value_groups,
)
from tabwright.operators.sketch import distinct_sketches, error_bound, merged_distinct, store_sketches
from tabwright.operators.skew import heavy_keys, spread_left_join
from tabwright.operators.split import (
    DuplicateKeys, exact_split, exact_test_flag, hash_folds, hash_split, stratified_folds,
)
from tabwright.operators.train import (
    FOREST_GRID, LOGISTIC_GRID, RECIPES, FourierFeatures, Prepared, Recipe, cross_validate, evaluate_prepared, final_predictions, final_test,
    fit_prepared, fit_recipe, forest, held_out_predictions, logistic, param_grid, predict, prepare, svm, train_and_evaluate,
)
from tabwright.operators.transform import LogAbs, ZScoreLog, feature_matrix, log1p_columns, log_abs_columns
from tabwright.operators.trim import SigmaTrim

__all__ = [
    "CountedForest", "DropSparse", "DuplicateKeys", "FOREST_GRID", "FourierFeatures", "Impute", "LOGISTIC_GRID", "LogAbs", "MOST_LABELS",
    "NystroemFeatures", "NystroemModel", "OneAgainstRest", "OneAgainstRestModel", "Prepared", "RECIPES", "Recipe", "SigmaTrim", "TargetEncode", "ZScoreLog", "add_null", "band_lookup", "best_model",
    "binary_metrics", "by_class", "cardinality_profile", "cast_numeric", "class_items", "column_modes", "compare_models",
    "cross_validate", "distinct_sketches", "drop_columns", "error_bound", "evaluate_prepared", "exact_split", "exact_test_flag", "feature_matrix", "final_predictions", "final_test", "fit_prepared",
    "fit_recipe", "fold_accuracy", "forest", "hash_folds", "hash_split", "heavy_keys", "held_out_predictions", "invalidate", "key_grid", "list_items",
    "list_tail", "log1p_columns", "log_abs_columns", "logistic", "lookup", "mean_fold_accuracy", "merged_distinct", "metrics_long",
    "missing_profile", "numeric_profile", "page_lists", "param_grid", "predict", "prepare", "prob_impute", "rate_grid", "rename",
    "require", "roc_auc", "route", "row_count", "select_at", "skew_profile", "spread_left_join", "stack", "store_sketches", "stratified_folds",
    "svm", "table_rows", "train_and_evaluate", "value_groups", "weighted_metrics",
]
