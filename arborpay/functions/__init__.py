"""Exact money arithmetic, configuration and period functions."""
