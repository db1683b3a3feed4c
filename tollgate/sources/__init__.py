from tollgate.sources.tables import RELATIONS, Tables, read_tables, write_tables
from tollgate.sources.testdata import derive_tables

__all__ = ["RELATIONS", "Tables", "derive_tables", "read_tables", "write_tables"]
