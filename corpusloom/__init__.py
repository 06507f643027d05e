"""Operators, sources and functions of an instruction corpus, as plans of Spark."""
