"""Compositions of the operators: the model build, the quality rules, the daily job."""
