"""Composite pipelines (C01-C08) and the stand-in inputs."""

from panelkit.plans.indicators import (
    conversion_monthly, merge_states, monthly_from_state, monthly_indicators, monthly_state, yearly_from_state, yearly_indicators,
)
from panelkit.plans.model import (
    certificate, labelled_model_table, prepare_training, read_model_set, train_value_model, write_model_sets,
)
from panelkit.plans.register import (
    PANEL_COLUMNS, CleanOptions, RegisterPanel, base_from_rows, build_panel, clean_base_year, clean_history, clean_main_year, encode_main,
    fit_fsa_dictionary, history_from_rows, materialize, prepare_history, register_panel, select_valid,
    typed_history, typed_main, with_codes,
)

__all__ = [n for n in dir() if not n.startswith("_")]
