"""Registered queries: how each operator is bound to the tables, and its SQL oracle."""
