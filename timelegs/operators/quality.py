"""Keys, value rules and expectations, counted with plain aggregates."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rules of the serving tables. Fixed values. A rule that is unknown (NULL) does not fail.
RULES = {
    "stops": {
        "latitude_range": "latitude BETWEEN -90 AND 90",
        "longitude_range": "longitude BETWEEN -180 AND 180",
    },
    "model_results": {
        "rank_positive": "rank_by_rmse >= 1",
        "rmse_not_negative": "rmse >= 0",
        "mae_not_negative": "mae >= 0",
        "training_seconds_not_negative": "training_seconds >= 0",
        "evaluation_seconds_not_negative": "evaluation_seconds >= 0",
    },
    "segments": {
        "hour_range": "departure_hour BETWEEN 0 AND 23",
        "peak_flag": "is_peak_hour IN (0, 1)",
        "distance_not_negative": "distance_km >= 0",
        "runtime_positive": "runtime_minutes > 0",
        "iqr_flag": "is_iqr_high_duration IN (0, 1)",
    },
    "predictions": {
        "distance_not_negative": "distance_km >= 0",
        "runtime_positive": "actual_runtime_minutes > 0",
        "error_not_negative": "absolute_error_minutes >= 0",
        "anomaly_flag": "is_model_anomaly IN (0, 1)",
    },
}

NOT_NULL = {
    "stops": ["stop_name", "latitude", "longitude"],
    "model_results": [
        "rank_by_rmse",
        "configuration",
        "rmse",
        "mae",
        "r2",
        "training_seconds",
        "evaluation_seconds",
    ],
    "segments": [
        "source_file",
        "vehicle_journey_code",
        "line_ref",
        "segment_key",
        "departure_time",
        "departure_hour",
        "time_of_day",
        "is_peak_hour",
        "from_stop_ref",
        "to_stop_ref",
        "distance_km",
        "runtime_minutes",
        "is_iqr_high_duration",
    ],
    "predictions": [
        "model_name",
        "source_file",
        "vehicle_journey_code",
        "line_ref",
        "segment_key",
        "departure_time",
        "from_stop_ref",
        "to_stop_ref",
        "distance_km",
        "actual_runtime_minutes",
        "predicted_runtime_minutes",
        "residual_minutes",
        "absolute_error_minutes",
        "is_model_anomaly",
        "anomaly_direction",
    ],
}

PRIMARY_KEYS = {
    "stops": ["stop_ref"],
    "model_results": ["model_name"],
    "segments": ["segment_id"],
    "predictions": ["prediction_id"],
}

# Tables whose key is a number given by ``assign_ids``.
NUMBERED = {"segments", "predictions"}

# child table, child column, parent table, parent column
FOREIGN_KEYS = [
    ("segments", "from_stop_ref", "stops", "stop_ref"),
    ("segments", "to_stop_ref", "stops", "stop_ref"),
    ("predictions", "model_name", "model_results", "model_name"),
    ("predictions", "from_stop_ref", "stops", "stop_ref"),
    ("predictions", "to_stop_ref", "stops", "stop_ref"),
]


class MissingColumnsError(ValueError):
    """An input lacks columns that its layout requires."""


class ConstraintError(RuntimeError):
    """Rows break the rules of the table that they are loaded into."""


class ExpectationError(RuntimeError):
    """A count or a set of columns is not what was expected."""


def require_columns(df: DataFrame, required: list[str], what: str = "input") -> DataFrame:
    """``df`` itself, or an error that names the missing columns; no job runs."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"{what} is missing columns: {', '.join(missing)}")
    return df


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated or NULL keys with the number of rows that hold them."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter((F.col("row_count") > 1) | has_null)
    )


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: NULLs per column that must not hold any."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def check_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row: how many rows break each rule."""
    return df.agg(*[F.count_if(~F.expr(rule)).alias(name) for name, rule in rules.items()])


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-NULL values of ``column`` without a parent, with their row counts.

    The child is reduced to its distinct values first: only those are joined.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    parents = parent.select(F.col(key).alias("value"))
    return values.join(parents, "value", "left_anti")


def fk_violations(tables: Mapping[str, DataFrame], foreign_keys=None) -> DataFrame:
    """One row per foreign key: orphan values and the rows that hold them.

    The keys from one table to one other are looked up together, by one scan and one join.
    """
    together: dict[tuple[str, str, str], list[str]] = {}
    for child, column, parent, key in foreign_keys or FOREIGN_KEYS:
        together.setdefault((child, parent, key), []).append(column)
    parts = []
    for (child, parent, key), columns in together.items():
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        values = tables[child].select(F.explode(cells).alias("_cell")).select("_cell.*").filter("value IS NOT NULL")
        counted = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("row_count"))
        parents = tables[parent].select(F.col(key).cast("string").alias("value"))
        found = counted.join(parents, "value", "left_anti").agg(
            *[
                aggregate(F.when(F.col("column") == c, measure)).alias(f"{name} {c}")
                for c in columns
                for name, aggregate, measure in (("values", F.count, F.lit(1)), ("rows", F.sum, F.col("row_count")))
            ]
        )
        rows = [
            F.struct(
                F.lit(f"{child}.{c}").alias("foreign_key"),
                F.col(f"values {c}").alias("orphan_values"),
                F.coalesce(F.col(f"rows {c}"), F.lit(0)).alias("orphan_rows"),
            )
            for c in columns
        ]
        parts.append(found.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def rule_counts(table: str) -> list[Column]:
    """Aggregates: how many rows of a serving table break each of its NOT NULL and value rules.

    Key columns must not be NULL either. Rows of a numbered table also give what tells that its
    ids are 1 to n: their least and greatest, and the sums of the ids and of their squares.
    """
    keys = PRIMARY_KEYS[table]
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in [*keys, *NOT_NULL[table]]]
    counts += [F.count_if(~F.expr(rule)).alias(name) for name, rule in RULES[table].items()]
    if table in NUMBERED:
        number = F.col(keys[0]).cast("decimal(19,0)")
        counts += [F.min(keys[0]).alias("_least"), F.max(keys[0]).alias("_greatest")]
        counts += [F.sum(number).alias("_sum"), F.sum(number * number).alias("_squares")]
    return counts


def table_violations(df: DataFrame, table: str) -> DataFrame:
    """One row: how many rows of a serving table break each of its NOT NULL and value rules.

    One aggregate over the table; key columns must not be NULL either.
    """
    counts = df.agg(*rule_counts(table))
    return counts.select(*[c for c in counts.columns if not c.startswith("_")])


def _numbered_densely(measured: Mapping) -> bool:
    """Whether the measures taken on a write are those of the ids 1 to n, each once."""
    n = measured["rows"]
    if not n:
        return True
    sums = (measured["_sum"], measured["_squares"])
    wanted = (n * (n + 1) // 2, n * (n + 1) * (2 * n + 1) // 6)
    return (measured["_least"], measured["_greatest"]) == (1, n) and tuple(map(int, sums)) == wanted


def require_constraints(tables: Mapping[str, DataFrame], measured: Mapping[str, Mapping] | None = None) -> None:
    """An error with the counts of all broken rules of the serving tables, if there are any.

    Null, value, key and reference rules; a repeated key counts with all of its rows. What was
    ``measured`` on the write of a table (``rule_counts`` and its rows) isn't counted again: then
    only keys that aren't dense numbers and the references are read back.
    """
    broken = {}
    for table, df in tables.items():
        known = (measured or {}).get(table)
        found = dict(known or table_violations(df, table).first().asDict())
        if not (known and table in NUMBERED and _numbered_densely(known)):
            keys = pk_violations(df, PRIMARY_KEYS[table])
            found["repeated_key"] = keys.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
        counts = {rule: n for rule, n in found.items() if rule != "rows" and not rule.startswith("_")}
        broken.update({f"{table}.{rule}": n for rule, n in counts.items() if n})
    known = [k for k in FOREIGN_KEYS if k[0] in tables and k[2] in tables]
    for row in fk_violations(tables, known).collect():
        if row["orphan_rows"]:
            broken[f"{row['foreign_key']}_unknown"] = row["orphan_rows"]
    if broken:
        raise ConstraintError("; ".join(f"{rule}: {n} rows" for rule, n in sorted(broken.items())))


def invalid_segments(segments: DataFrame) -> DataFrame:
    """One row: segments with a run time or distance that is not positive, or with no stops."""
    bad = (
        (F.col("runtime_minutes") <= 0)
        | (F.col("distance_km") <= 0)
        | F.col("from_stop_ref").isNull()
        | F.col("to_stop_ref").isNull()
    )
    return segments.agg(F.count_if(bad).alias("invalid_segments"))


def key_exists(df: DataFrame, column: str, value) -> DataFrame:
    """One boolean: whether any row holds the value."""
    return df.agg(F.coalesce(F.bool_or(F.col(column) == F.lit(value)), F.lit(False)).alias("found"))


def expect(df: DataFrame, rows: int | None = None, columns: int | None = None) -> DataFrame:
    """``df`` itself, or an error when its size is not the expected one."""
    if columns is not None and len(df.columns) != columns:
        raise ExpectationError(f"expected {columns} columns, found {len(df.columns)}")
    if rows is not None:
        found = df.count()
        if found != rows:
            raise ExpectationError(f"expected {rows} rows, found {found}")
    return df
