"""Adapters from the benchmark tables, query registry and oracle SQL."""
