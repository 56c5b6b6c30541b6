"""Layered lake analytics on Spark: raw landing, typed domain tables, KPI tables, checks, serving."""
