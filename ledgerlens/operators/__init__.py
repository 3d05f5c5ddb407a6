"""The 57 analytics operators (plus corrected variants) and the shared
distributed helpers ``ordered`` (global order statistics) and ``basket``
(co-occurrence)."""

# Final sorts of entity-sized results end with a key: Spark range-partitions a
# global ORDER BY, and equal sort keys cannot be split across tasks, so a
# low-cardinality leading key (e.g. a 3-valued recommendation) would otherwise
# put a third of all rows into one sort task.  Ties are unordered in the
# original statements, so the extra key changes no result.
