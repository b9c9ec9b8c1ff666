"""spanloom: offset-exact annotation analytics over free text, on PySpark."""

__version__ = "0.1.0"
