"""Compositions of operators: load, corrupt, gate, remediate, train."""
