"""The published queries: operators applied to the test tables, and their SQL twins."""
