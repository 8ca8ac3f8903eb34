"""Declarative rule sets compiled to DataFrame plans, and the layer jobs."""
