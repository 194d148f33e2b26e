from starloom.plans.oracle import ORACLE
from starloom.plans.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
