"""The scalar functions under SQL names, for ad hoc queries over registered snapshot views.

They are SQL functions, which Catalyst inlines into the calling query; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from snapdelta.functions.scalars import DEFINITIONS

SIGNATURES = {
    "hit_ratio": (("reads", "hits"), "double", "double"),
    "per_unit": (("units", "total"), "double", "double"),
    "percent_of": (("total", "part"), "double", "double"),
    "blocks_to_bytes": (("blocks",), "bigint", "bigint"),
    "human_bytes": (("size",), "double", "string"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session and return their names."""
    for name, (arguments, taken, given) in SIGNATURES.items():
        declared = ", ".join(f"{a} {taken}" for a in arguments)
        body = DEFINITIONS[name](*arguments)
        spark.sql(f"create or replace temporary function {name}({declared}) returns {given} return {body}")
    return list(SIGNATURES)
