from retail_lake.functions.calendar import calendar_parts

__all__ = ["calendar_parts"]
