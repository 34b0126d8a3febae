"""Whole plans: the layer steps and the registered queries."""
