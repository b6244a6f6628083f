"""Column expressions shared by the operators."""

from purchaseflow.functions.columns import any_null

__all__ = ["any_null"]
