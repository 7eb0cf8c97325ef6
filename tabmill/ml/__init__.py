"""Spark ML estimators: preprocessing, regressors, target transform, neural net."""
