"""Scalar functions, as Column expressions where Spark can say them and as Arrow functions where it can't."""
