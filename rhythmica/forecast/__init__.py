"""Forecasters: per-series models from distributed sufficient statistics, and tree learners."""
