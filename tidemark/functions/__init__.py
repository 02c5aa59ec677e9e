"""Scalar expressions.  Each takes and returns Spark Columns; none is a UDF."""
