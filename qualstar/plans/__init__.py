"""Composed jobs: tax pipeline, DQ run, analytics, registered queries."""
