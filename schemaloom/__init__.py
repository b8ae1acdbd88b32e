"""schemaloom: schema-catalog relations and large-scale data checks on PySpark."""

__version__ = "0.2.0"
