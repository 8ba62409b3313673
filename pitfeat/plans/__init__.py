"""Composite plans: training sets, feature specs, search spaces, model fitting."""
