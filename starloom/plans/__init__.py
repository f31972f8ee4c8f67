"""Declarative star-schema specs, jobs and the operator queries."""
