"""SQL scalar UDFs.

They are SQL-bodied temporary functions, so Catalyst inlines them into the
calling plan (no Python, no serialisation, whole-stage codegen intact).
Text is trimmed first: a leading space would otherwise yield '' as the first
word.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_UDFS = {
    "get_row": ("s STRING", "INT", "try_cast(regexp_replace(s, '[^0-9]', '') AS INT)"),
    "get_seat": ("s STRING", "STRING", "substring(regexp_replace(s, '[^A-Z]', ''), 1, 1)"),
    "get_first_name": ("s STRING", "STRING", "split_part(trim(s), ' ', 1)"),
    "get_last_name": ("s STRING", "STRING", "split_part(trim(s), ' ', -1)"),
}


def register_sql_udfs(spark: SparkSession) -> list[str]:
    for name, (args, ret, body) in SQL_UDFS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(SQL_UDFS)
