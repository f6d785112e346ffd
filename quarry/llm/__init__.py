"""Operators of a training-data pipeline, each a plain function over DataFrames.

One module per operator; ``queries`` registers them over the driver's tables.
Nothing else in the library imports this subpackage."""
