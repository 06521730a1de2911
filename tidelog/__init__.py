"""tidelog: change-data processing expressed as PySpark DataFrame plans."""

__version__ = "0.1.0"
