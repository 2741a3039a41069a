from .columns import (
    all_present,
    any_missing,
    any_present,
    class_label,
    decision,
    is_blank,
    is_finite,
    is_number,
    is_present,
    name_of,
    nan_to_null,
    number_of,
    remap_prefix,
    replace_text,
    sigmoid,
    stem,
)
from .ranks import range_buckets, row_positions, running_total
from .shuffles import shuffled_place
from .skew import HOT_ROWS, hot_keys, salted_join
from .staging import clear_staged, stage, staging_dir

__all__ = [
    "HOT_ROWS", "all_present", "any_missing", "any_present", "class_label", "clear_staged", "decision", "hot_keys",
    "is_blank", "is_finite", "is_number", "is_present", "name_of", "nan_to_null", "number_of", "range_buckets",
    "remap_prefix", "replace_text", "row_positions", "running_total", "salted_join", "shuffled_place", "sigmoid", "stage", "staging_dir",
    "stem",
]
