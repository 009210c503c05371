"""quaymark: catalogue, commerce and listing analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
