"""Whole jobs: ingest, views, training and forecasting, composed from the operators."""
