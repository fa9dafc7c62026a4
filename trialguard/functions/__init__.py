"""Column expressions (E1-E23): parsing, terminology, derivations, statistics, formatting."""

from trialguard.functions.formatting import fixed, for_transport, n_pct
from trialguard.functions.parsing import iso_date, is_iso_text, to_number, toxicity_grade
from trialguard.functions.stats import newcombe_diff, wilson
from trialguard.functions.terms import (
    age_group,
    arm_number,
    blank_to,
    change,
    duration_days,
    flag,
    is_in,
    iso_text,
    lookup,
    parameter_label,
    percent_change,
    race_upper,
    range_indicator,
    ratio_to_uln,
    severity,
    sex_term,
    study_day,
    treatment_emergent,
    usubjid,
    yes_no,
)

__all__ = [
    "age_group", "arm_number", "blank_to", "change", "duration_days", "fixed", "flag",
    "for_transport", "is_in", "is_iso_text", "iso_date", "iso_text", "lookup", "n_pct",
    "newcombe_diff", "parameter_label", "percent_change", "race_upper", "range_indicator",
    "ratio_to_uln", "severity", "sex_term", "study_day", "to_number", "toxicity_grade",
    "treatment_emergent", "usubjid", "wilson", "yes_no",
]
