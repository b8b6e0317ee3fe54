"""User-level operators (``DataFrame -> DataFrame``), grouped by theme."""

from casebook.operators import aggregates, billing, cleaning, ledger, loyalty, recipes, sequence

__all__ = ["aggregates", "billing", "cleaning", "ledger", "loyalty", "recipes", "sequence"]
