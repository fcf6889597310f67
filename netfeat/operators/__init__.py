"""Operators: cleaning, risk flags, snapshots, graph algorithms, skew handling."""
