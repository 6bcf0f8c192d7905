from stratum.streaming.bronze import compact_bronze, drop_old_parts, read_bronze
from stratum.streaming.file_load import load_new_files

__all__ = ["compact_bronze", "drop_old_parts", "load_new_files", "read_bronze"]
