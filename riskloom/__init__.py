"""Binary-outcome risk analytics on Spark DataFrames."""

from riskloom.roles import DEFAULT_ROLES, Roles

__all__ = ["DEFAULT_ROLES", "Roles"]
