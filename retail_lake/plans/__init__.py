from retail_lake.plans.jobs import run_shop_day, run_stock_days
from retail_lake.plans.silver import StageCounts, to_silver

__all__ = ["StageCounts", "run_shop_day", "run_stock_days", "to_silver"]
