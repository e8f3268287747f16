"""Row-for-row comparison of a Spark result with a DuckDB result."""

import math
from collections import Counter


def _value(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_value(v) for v in value)
    return str(value)


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(spark_df, duck, sql):
    """Empty text if both give the same columns and the same bag of rows."""
    wanted = duck.execute(sql)
    columns = [d[0] for d in wanted.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(columns)}"
    right = as_bag(columns, wanted.fetchall())
    left = as_bag(spark_df.columns, spark_df.collect())
    if left == right:
        return ""
    return (
        f"{left.total()} rows instead of {right.total()}; "
        f"extra {list((left - right).items())[:2]}; missing {list((right - left).items())[:2]}"
    )
