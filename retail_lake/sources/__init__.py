from retail_lake.sources.claims import Claims, ConcurrentLoad
from retail_lake.sources.daily import (
    NoData,
    Unauthorized,
    backfill,
    daily_source,
    get_days,
    missing_days,
    read_source,
    update_days,
)
from retail_lake.sources.files import (
    answered_days,
    clear,
    dated_name,
    open_table,
    read_day,
    read_days,
    save_table,
    stored_days,
    write_day,
    write_days,
)
from retail_lake.sources.jdbc import ChangedMeanwhile, JdbcTarget, snapshot, unchanged
from retail_lake.sources.targets import BucketedTarget, ParquetTarget

__all__ = [
    "BucketedTarget",
    "ChangedMeanwhile",
    "Claims",
    "ConcurrentLoad",
    "JdbcTarget",
    "NoData",
    "ParquetTarget",
    "Unauthorized",
    "answered_days",
    "backfill",
    "clear",
    "daily_source",
    "dated_name",
    "get_days",
    "missing_days",
    "open_table",
    "read_day",
    "read_days",
    "read_source",
    "save_table",
    "snapshot",
    "stored_days",
    "unchanged",
    "update_days",
    "write_day",
    "write_days",
]
