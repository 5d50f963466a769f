"""Query plans of every layer, as DataFrame functions."""

from mktlens.plans.warehouse import Warehouse

__all__ = ["Warehouse"]
