from reviewflow.sources.jdbc import jdbc_bounds, jdbc_table_exists, read_table, read_table_partitioned  # noqa: F401
from reviewflow.sources.landing import (  # noqa: F401
    NoLandedFiles, compact_landing, has_landed_file, landed_file_count, scan_landing,
)
