"""Column-level building blocks; every function maps columns to columns."""
