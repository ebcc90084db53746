"""Table-in / table-out Spark operators for credit-risk style analytics."""

__version__ = "0.1.0"
