"""tallyloom: Spark-native planning, audit, reconciliation and text preparation of large collections."""

__version__ = "0.1.0"
