from .etl import MinimalConfig, RunConfig, etl_cloud_min, etl_run
from .table import feature_table

__all__ = ["MinimalConfig", "RunConfig", "etl_cloud_min", "etl_run", "feature_table"]
