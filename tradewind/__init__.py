"""Marketplace order analytics as Spark DataFrame jobs."""

from tradewind.session import get_spark
from tradewind.plans.warehouse import Warehouse

__all__ = ["Warehouse", "get_spark"]
