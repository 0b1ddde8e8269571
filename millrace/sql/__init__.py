"""The SQL front end: PostgreSQL-flavoured text in, Spark plans out."""

from millrace.sql.dialect import expression, query
from millrace.sql.engine import Engine

__all__ = ["Engine", "expression", "query"]
