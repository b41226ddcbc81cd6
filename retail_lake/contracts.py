"""Gold table contracts: columns, key, NOT NULL and text length rules.

A contract is what the warehouse would otherwise enforce with its DDL. It is
checked on Spark before anything is written, because neither a Parquet target
nor a half-finished JDBC append can take a bad row back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


class ContractViolation(ValueError):
    """Rows that a target may not take.

    ``findings`` says which rules are broken and how often; ``staged``, where
    set, is the staged table that holds the refused rows.
    """

    def __init__(self, table: str, findings: list[str], staged=None):
        super().__init__(f"{table}: " + "; ".join(findings))
        self.table = table
        self.findings = findings
        self.staged = staged


@dataclass(frozen=True)
class Contract:
    """``columns`` may use ``VarcharType``; ``schema`` gives the plain types.

    ``day`` names a date column *of the key*. A batch can only match target
    rows inside its own date range, so a merge reads just that range, and file
    targets are partitioned by it.
    """

    name: str
    columns: T.StructType
    key: tuple[str, ...]
    day: str | None = None

    def __post_init__(self):
        loose = [c for c in self.key if self.columns[c].nullable]
        if loose:
            raise ValueError(f"{self.name}: key columns must be NOT NULL: {loose}")
        if self.day is not None and self.day not in self.key:
            raise ValueError(f"{self.name}: {self.day} is not part of the key")

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType,
                    f.nullable,
                )
                for f in self.columns
            ]
        )

    @property
    def lengths(self) -> dict[str, int]:
        return {
            f.name: f.dataType.length
            for f in self.columns
            if isinstance(f.dataType, T.VarcharType)
        }


def _contract(name, key, columns, day=None):
    fields = [
        T.StructField(column, type_, nullable=column not in key and not required)
        for column, type_, required in columns
    ]
    return Contract(name, T.StructType(fields), tuple(key), day)


_INT, _SHORT, _DATE = T.IntegerType(), T.ShortType(), T.DateType()

CLIENTS = _contract(
    "clients",
    ["client_id"],
    [
        ("client_id", _INT, True),
        ("fullname", T.VarcharType(63), False),
        ("location_area_id", _INT, False),
    ],
)
LOCATION_AREAS = _contract(
    "location_areas",
    ["area_id"],
    [("area_id", _INT, True), ("area", T.VarcharType(64), False)],
)
PRODUCTS = _contract(
    "products",
    ["product_id"],
    [
        ("product_id", _INT, True),
        ("product_name", T.VarcharType(255), False),
        ("aisle", T.VarcharType(127), False),
        ("department", T.VarcharType(127), False),
    ],
)
STORES = _contract(
    "stores",
    ["store_id"],
    [
        ("store_id", _INT, True),
        ("location_area_id", _SHORT, False),
        ("store_type", T.VarcharType(64), False),
    ],
)
DATES = _contract(
    "dates",
    ["order_date"],
    [
        ("order_date", _DATE, True),
        ("date_week", _INT, True),
        ("date_month", _INT, True),
        ("date_year", _INT, True),
        ("date_weekday", _INT, True),
    ],
)
ORDERS = _contract(
    "orders",
    ["product_id", "client_id", "order_date", "store_id"],
    [
        ("product_id", _INT, True),
        ("client_id", _INT, True),
        ("order_date", _DATE, True),
        ("store_id", _INT, True),
        ("quantity", _INT, False),
    ],
    day="order_date",
)
OUT_OF_STOCK = _contract(
    "out_of_stock",
    ["product_id", "order_date"],
    [
        ("product_id", _INT, True),
        ("order_date", _DATE, True),
        ("store_id", _INT, False),
    ],
    day="order_date",
)

GOLD: dict[str, Contract] = {
    c.name: c
    for c in (CLIENTS, LOCATION_AREAS, ORDERS, PRODUCTS, STORES, DATES, OUT_OF_STOCK)
}

# Columns the gold tables need of each shop source table (fixed values).
SHOP_COLUMNS: dict[str, list[str]] = {
    "orders": ["product_id", "client_id", "order_date", "store_id", "quantity"],
    "products": ["product_id", "product_name", "aisle_id", "department_id"],
    "departments": ["department_id", "department"],
    "aisles": ["aisle_id", "aisle"],
    "clients": ["client_id", "fullname", "location_area_id"],
    "stores": ["store_id", "location_area_id", "store_type_id"],
    "store_types": ["store_type_id", "type"],
    "location_areas": ["area_id", "area"],
}

#: What a day's out-of-stock document holds.
STOCK_SCHEMA = T.StructType(
    [T.StructField("product_id", T.LongType()), T.StructField("date", T.StringType())]
)
