"""Whole jobs: backtests, comparisons, table synthesis, leaderboards."""
