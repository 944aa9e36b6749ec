from reviewflow.sinks.envelope import landing_name, write_envelope  # noqa: F401
from reviewflow.sinks.tables import append_catalog_table, append_table, guarded_append, observed  # noqa: F401
