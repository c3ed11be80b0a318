"""Cohort analytics on Spark: relational, statistical and sequence operators as DataFrame functions."""
