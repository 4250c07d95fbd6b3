"""Relational operators: dedup, lookups, incremental loads, aggregates, checks."""

from .aggregate import dim_from_groups, key_pool, null_counts, ratio_pct
from .dedup import latest_per_key, latest_split, total_tiebreak
from .incremental import (VersionedTable, incremental_slice, sync_columns, upsert,
                          upsert_partitions, upsert_table, watermark)
from .lookup import frequent_keys, lookup, lookup_split, orphans
from .quality import (Check, ReconcilePair, Relation, check_accepted, check_at_least_one,
                      check_count, check_expr, check_fk, check_not_null, check_range,
                      check_unique, inactive_dim_rows, null_fk_report, reconcile, reconcile_counts, ri_report,
                      run_suite, with_severity)

__all__ = [n for n in dir() if not n.startswith("_")]
