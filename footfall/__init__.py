"""footfall: presence analytics at a place from mobile-network traces, on Spark.

Dwells, visit frequency, visitor origin and arrival mode / time-band
attachment, each as DataFrame -> DataFrame operators (see ``operators``).
"""

from .params import DEFAULT, Params

__all__ = ["DEFAULT", "Params"]
