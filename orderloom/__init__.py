"""orderloom: event, order-cycle and demand analytics as composable Spark DataFrame operators."""

from orderloom.params import Params

__all__ = ["Params"]
