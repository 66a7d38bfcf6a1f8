from .files import (read_csv, read_csv_by_name, read_parquet, read_parquet_glob, read_text_lines,
                    write_bucketed_table, write_csv, write_parquet, write_text)
from .labels import (code_labels, countries, ports, states, label_lines)

__all__ = [
    "read_csv", "read_csv_by_name", "read_parquet", "read_parquet_glob", "read_text_lines",
    "write_bucketed_table", "write_csv", "write_parquet", "write_text",
    "code_labels", "countries", "ports", "states", "label_lines",
]
