"""DataFrame operators."""

from panelkit.operators.encode import (
    LEGAL_TYPES, ZONE_CODES, ZONE_NAMES, category_codes, encode_categories, encode_legal, encode_zone, fit_categories,
    map_values, map_values_expr, onehot_strings, zone_mapping,
)
from panelkit.operators.evaluate import accuracy, rmse, rmse_by_class, two_stage_metrics
from panelkit.operators.features import (
    CODE_BLOCKS, FEATURE_NUMERIC, MODEL_NUMERIC, FeatureParams, apply_feature_pipeline, assemble_features,
    cast_numeric, fit_feature_pipeline, fit_standardizer, fit_year_scale, has_all_features, pca_project, scale_year,
    standardize, weight_by_correlation,
)
from panelkit.operators.indicators import (
    join_indicators, mean_by_month, mean_by_year, mean_value, model_table, resample_month_to_year,
)
from panelkit.operators.keys import dedup_by_key, dedup_within_key, distinct_values, hash_bucket, hash_split, number_rows, split_label
from panelkit.operators.models import (
    TwoStageResult, fit_band_classifier, fit_per_class_regression, predict_band, predict_per_class, two_stage_model,
)
from panelkit.operators.moments import (
    class_moments, fit_vector_regressions, predict_vector_regressions, score_equations, solve_moments,
)
from panelkit.operators.projection import project, project_rename
from panelkit.operators.panel import backfill_attribute, fill_from, impute_prior, prior_value, stack_years
from panelkit.operators.quality import (
    QualityWatch, complete_cases, correlate_with, correlation_list, describe_numeric, quality_report,
)

__all__ = [n for n in dir() if not n.startswith("_")]
