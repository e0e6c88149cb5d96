"""truerow: keep product master data correct with Spark jobs.

Raw record extracts are folded into one current row per (endpoint, record id),
references between record types are measured, product documents are checked
against a rule set, and every run is compared with the one before it.
"""

from truerow.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
