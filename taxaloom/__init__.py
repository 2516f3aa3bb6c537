"""taxaloom: reconciliation of scientific name-strings as Spark dataflow."""

__version__ = "0.1.0"
