"""Wiring: a whole study, and the operators applied to the warehouse tables."""
