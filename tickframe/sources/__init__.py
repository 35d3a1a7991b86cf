from .tables import load_table, read_csv_typed, register_view, drop_view  # noqa: F401
from .fixtures import technicals_raw, fundamentals_raw  # noqa: F401
from .sinks import write_table, write_csv, write_by_key  # noqa: F401
