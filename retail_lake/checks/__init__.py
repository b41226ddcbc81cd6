from retail_lake.checks.oracles import ORACLES
from retail_lake.checks.queries import registered

__all__ = ["ORACLES", "registered"]
