"""Analytical jobs: refresh, features, models, scores and reports."""
