from retail_lake.operators.conform import (
    bad_rows,
    conform,
    conform_marked,
    schema_differences,
    validate,
)
from retail_lake.operators.joins import join_dimensions, new_rows
from retail_lake.operators.merge import Inserted, insert_new
from retail_lake.operators.quality import (
    clean_stock,
    contract_report,
    drop_unknown,
    duplicate_keys,
    first_per_key,
)

__all__ = [
    "Inserted",
    "bad_rows",
    "clean_stock",
    "conform",
    "conform_marked",
    "contract_report",
    "drop_unknown",
    "duplicate_keys",
    "first_per_key",
    "insert_new",
    "join_dimensions",
    "new_rows",
    "schema_differences",
    "validate",
]
