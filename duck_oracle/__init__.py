"""Oracle SQL for DuckDB: each registered query written independently as
plain SQL over the driver's parquet views (see ``oracle.queries``)."""

from duck_oracle.queries import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
