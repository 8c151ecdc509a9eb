"""Image-record cleaning, features, quality checks and model evaluation on Spark."""

__version__ = "0.1.0"
