"""Jobs: backfill, re-sort, polling, audit, and the versioned tables they write."""
