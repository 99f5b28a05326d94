from rivalry.sources import fixtures
from rivalry.sources.sinks import overwrite_partitions
from rivalry.sources.tables import read_table

__all__ = ["fixtures", "overwrite_partitions", "read_table"]
