"""Panel analytics on Spark: validate, clean, integrate, derive, score, profile and model
tables that hold one row per (entity, date)."""
