"""Table sources, sinks and canonical views."""
