"""tidemark: drift, evaluation and model-refresh operators as Spark DataFrame code."""

__version__ = "0.1.0"
