"""Registered queries over the test tables, with SQL twins for an independent engine."""
