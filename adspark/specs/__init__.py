"""Table specifications as data.

``tables.json`` holds the 36 configured tables: 21 report fact tables and 15 entity snapshot
tables, each with partition / cluster / index columns, the load method, merge keys and the typed
schema. The values are configuration of the ingested warehouse and must match it; they are kept
as data, never as code.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import types as T

# Config type name -> Spark type and the default applied when a cast yields nothing.
SPARK_TYPES = {
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
}

TABLE_TYPES = ("report", "entity", "general")
AD_TYPES = ("SP", "SB", "SD", "DSP", "ST")


@dataclass(frozen=True)
class TableSpec:
    table_type: str
    ad_type: str
    name: str
    dataset: str
    table_name: str
    partition_column: str | None
    cluster_columns: tuple
    index_columns: tuple
    load_method: str
    merge_columns: tuple
    columns: tuple  # ((name, config_type), ...)

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def types(self) -> dict[str, str]:
        return dict(self.columns)

    def spark_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, SPARK_TYPES.get(t, T.StringType()), True)
                             for c, t in self.columns])

    @property
    def qualified_name(self) -> str:
        return f"{self.dataset}.{self.table_name}"


def _freeze(obj):
    if isinstance(obj, list):
        return tuple(_freeze(x) for x in obj)
    return obj


@lru_cache(maxsize=1)
def load_specs() -> tuple[TableSpec, ...]:
    path = os.path.join(os.path.dirname(__file__), "tables.json")
    with open(path) as f:
        raw = json.load(f)
    specs = []
    for r in raw:
        specs.append(TableSpec(
            table_type=r["table_type"], ad_type=r["ad_type"], name=r["name"], dataset=r["dataset"],
            table_name=r["table_name"], partition_column=r["partition_column"],
            cluster_columns=_freeze(r["cluster_columns"]), index_columns=_freeze(r["index_columns"]),
            load_method=r.get("load_method") or "merge", merge_columns=_freeze(r["merge_columns"]),
            columns=tuple((c, t) for c, t in r["columns"]),
        ))
    return tuple(specs)


def get_spec(table_type: str, ad_type: str, name: str) -> TableSpec:
    """Look up one table; an unknown table raises a clear error."""
    for s in load_specs():
        if s.table_type == table_type and s.ad_type == ad_type and s.name == name:
            return s
    raise KeyError(f"no table configured for table_type={table_type!r} ad_type={ad_type!r} name={name!r}")
