"""panelcast: a Spark-native engine for forecasting data work.

Every operator is a DataFrame -> DataFrame function whose column roles
(entity, time, target) are arguments; Catalyst plans the work.
"""

from panelcast.schema import Roles

__all__ = ["Roles"]
__version__ = "0.1.0"
