"""DataFrame -> DataFrame operators. All lazy; all take column names as parameters."""

from .profile import (
    amount_stats,
    bucketize,
    conditional_counts,
    group_profile,
    null_profile,
    sector_rollup,
    share_of_total,
    top_k,
)
from .dedup import duplicate_keys, first_wins
from .quality import Rule, broken_rules, code_values, drop_fk_flags, fk_rules, orphan_counts, rule_counts, split_valid, unknown_values
from .ranks import percentiles_disc
from .dimensions import grow_dimension, insert_if_absent
from .joins import lookup_label, star_join

__all__ = [
    "amount_stats", "bucketize", "conditional_counts", "group_profile", "null_profile",
    "sector_rollup", "share_of_total", "top_k", "duplicate_keys", "first_wins", "Rule",
    "broken_rules", "code_values", "drop_fk_flags", "fk_rules", "orphan_counts", "percentiles_disc", "rule_counts",
    "split_valid", "unknown_values", "grow_dimension", "insert_if_absent", "lookup_label", "star_join",
]
