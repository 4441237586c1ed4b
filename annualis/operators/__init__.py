from annualis.operators.annual import annualise, annual_days, firm_years, with_days_lags
from annualis.operators.assemble import (
    PANEL_COLUMNS, assemble_panel, panel_summary, row_counts,
)
from annualis.operators.attributes import (
    collapse_education, deflate, demographics_join, family_composition, geography,
    reclassify_contract,
)
from annualis.operators.contributions import attach_contributions, merge_contributions
from annualis.operators.entity import (
    cohort_of, consolidate_entity, entity_of_state, entity_state, join_household, merge_entity_states, panel_span,
    rectangularise,
)
from annualis.operators.episodes import (
    classify_episode, expand_to_years, monthly_days, prepare_episodes, restrict_to_cohort,
)
from annualis.operators.firms import apply_firm_id, firm_id_correction, firm_panel
from annualis.operators.income import income_by_firm, retirement_year, split_payments
from annualis.operators.keys import dedup_by_key, drop_conflicting_keys, keep_top
from annualis.operators.report import ERROR, estimated, exact, merge_states, person_states

__all__ = [
    "ERROR", "PANEL_COLUMNS", "annual_days", "annualise", "apply_firm_id", "assemble_panel",
    "attach_contributions", "classify_episode", "cohort_of", "collapse_education",
    "consolidate_entity", "dedup_by_key", "deflate", "demographics_join",
    "drop_conflicting_keys", "entity_of_state", "entity_state", "estimated", "exact", "expand_to_years", "family_composition", "firm_id_correction",
    "firm_panel", "firm_years", "geography", "income_by_firm", "join_household", "keep_top",
    "merge_contributions", "merge_entity_states", "merge_states", "monthly_days", "panel_span", "panel_summary",
    "person_states", "prepare_episodes",
    "reclassify_contract", "rectangularise", "restrict_to_cohort", "retirement_year",
    "row_counts", "split_payments", "with_days_lags",
]
