"""labelforge: label-distillation data work as Spark DataFrame jobs."""

__version__ = "0.1.0"
