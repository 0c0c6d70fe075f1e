from aerolag.sources.stage import held, stage_table
from aerolag.sources.tables import (
    list_folder,
    read_many,
    read_table,
    records_table,
    use_access_token,
    write_csv,
    write_table,
)

__all__ = [
    "held", "list_folder", "read_many", "read_table", "records_table",
    "stage_table", "use_access_token", "write_csv", "write_table",
]
