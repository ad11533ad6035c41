"""Registered queries: each pairs a Spark callable with the SQL that must give the same rows."""
