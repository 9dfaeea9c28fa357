"""Bindings of the test tables to the record shapes the operators read,
the registry of named queries, and their SQL oracle."""
