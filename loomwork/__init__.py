"""loomwork: assay, measurement and structure tables prepared for multi-task learning as plain Spark plans."""

__version__ = "0.1.0"
