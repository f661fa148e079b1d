from .csv import (
    LoadVerificationError, check_files, optimal_partitions, read_features, read_written,
    write_balanced, write_csv, write_listed, write_repartitioned, write_verified,
)

__all__ = [
    "LoadVerificationError", "check_files", "optimal_partitions", "read_features", "read_written",
    "write_balanced", "write_csv", "write_listed", "write_repartitioned", "write_verified",
]
