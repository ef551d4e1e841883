"""Chains of operators: mart, experiment, evaluation, interpretation."""
