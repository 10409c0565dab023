"""Whole forecasts: the feature table, its slices and the models on top."""
