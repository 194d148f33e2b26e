from starloom.sources import schemas
from starloom.sources.files import (
    partition_column,
    read_csv,
    read_csv_apart,
    read_dimension,
    read_table_list,
    save_dimension,
    write_csv,
    write_dimension,
)
from starloom.sources.scratch import materialize, scratch_path, scratch_root

__all__ = [
    "materialize",
    "partition_column",
    "read_csv",
    "read_csv_apart",
    "read_dimension",
    "read_table_list",
    "save_dimension",
    "schemas",
    "scratch_path",
    "scratch_root",
    "write_csv",
    "write_dimension",
]
