"""Layer plans: raw rows to domain tables to KPI tables to serving tables."""
