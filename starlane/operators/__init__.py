"""Table operators. Each takes DataFrames and returns a DataFrame, without running a job.

The exceptions are those that write a stage (``match``, ``write_checked``), ``key_filter``,
which builds a table of bits, and ``enforce``, which has to look at the (few) result rows of
the checks to decide whether to raise.
"""

from starlane.operators.dedup import dedup_first
from starlane.operators.exact import profile_exact
from starlane.operators.impute import donor_mean, fold_periods, impute_periods, unfold_periods
from starlane.operators.lookup import conform, enrich, recombine
from starlane.operators.match import Matched, key_filter, match, unmatched_counts
from starlane.operators.profile import (
    CountBy,
    Mean,
    category_counts,
    fold_codes,
    pivot_count,
    presum,
    profile,
    profile_preaggregated,
    profile_sums,
)
from starlane.operators.quality import (
    DataQualityError,
    audit,
    duplicate_keys,
    enforce,
    length_counts,
    null_counts,
    orphan_keys,
    report_of,
    write_checked,
)
from starlane.operators.rollup import build_dimension
from starlane.operators.shape import is_null, not_null, preview, row_count, union_rows

__all__ = [
    "CountBy",
    "DataQualityError",
    "Matched",
    "Mean",
    "audit",
    "build_dimension",
    "category_counts",
    "conform",
    "dedup_first",
    "donor_mean",
    "duplicate_keys",
    "enforce",
    "enrich",
    "fold_codes",
    "fold_periods",
    "impute_periods",
    "is_null",
    "key_filter",
    "length_counts",
    "match",
    "not_null",
    "null_counts",
    "orphan_keys",
    "pivot_count",
    "presum",
    "preview",
    "profile",
    "profile_exact",
    "profile_preaggregated",
    "profile_sums",
    "recombine",
    "report_of",
    "row_count",
    "unfold_periods",
    "union_rows",
    "unmatched_counts",
    "write_checked",
]
