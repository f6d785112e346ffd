"""quarry: Spark-native normalisation and meta-analytics for periodic
captures of nested JSON records.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built from
DataFrame/SQL expressions so Catalyst can prune, push down and plan it.
"""

from quarry.session import checkpoint_root, get_spark

__all__ = ["get_spark", "checkpoint_root"]
