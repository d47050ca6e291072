"""Composed jobs: spectral clustering, tuning curves, and the registered queries."""
