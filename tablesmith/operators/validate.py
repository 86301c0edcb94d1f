"""Validation against a declared schema (V1-V7).

Schema: ``{column: {"type": logical, "constraints": {"min": .., "max": .., "enum": [..]}}}``. Checks run in
the order V1 (column declared), V2 (physical dtype accepted by the logical type), V3 (enum; NULL is invalid),
V4 (range, only when both bounds exist; NULL fails); the first failure is the column's status. The data checks
for all columns are ONE aggregate; only a verdict per column reaches the driver (schema-bounded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.columns import quote
from tablesmith.sources.versions import publish

# Physical types each logical type accepts.
LOGICAL_TYPES = {
    "string": (T.StringType, T.CharType, T.VarcharType),
    "integer": (T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "boolean": (T.BooleanType,),
    "datetime": (T.TimestampType, T.TimestampNTZType),
}


def _fmt(x) -> str:
    return str(x)


def validation_checks(df: DataFrame, schema: dict) -> DataFrame:
    """Per column: (column, declared, dtype_ok, n_invalid_enum, n_out_of_range, status, valid)."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    plan = []
    for i, c in enumerate(df.columns):
        spec = schema.get(c)
        if not spec:
            plan.append((c, False, False, None, None))
            continue
        accepted = LOGICAL_TYPES.get(spec.get("type"), ())
        ok = isinstance(dtypes[c], accepted)
        cons = spec.get("constraints") or {}
        enum_i = range_i = None
        if ok and "enum" in cons:
            col = F.col(quote(c))
            aggs.append(F.count_if(col.isNull() | ~col.isin(list(cons["enum"]))).alias(f"_e{i}"))
            enum_i = f"_e{i}"
        if ok and "min" in cons and "max" in cons:
            col = F.col(quote(c))
            inside = F.coalesce((col >= F.lit(cons["min"])) & (col <= F.lit(cons["max"])), F.lit(False))
            aggs.append(F.count_if(~inside).alias(f"_r{i}"))
            range_i = f"_r{i}"
        plan.append((c, True, ok, enum_i, range_i))
    wide = df.agg(*aggs) if aggs else df.sparkSession.range(1).select(F.lit(0).alias("_none"))
    rows = []
    for c, declared, ok, enum_i, range_i in plan:
        spec = schema.get(c) or {}
        cons = spec.get("constraints") or {}
        e = F.col(enum_i) if enum_i else F.lit(None).cast("long")
        r = F.col(range_i) if range_i else F.lit(None).cast("long")
        if not declared:
            status = F.lit("Column missing in schema")
        elif not ok:
            status = F.lit(f"Incorrect dtype: expected {spec.get('type')}, got {dtypes[c].simpleString()}")
        else:
            status = F.lit("Valid")
            if range_i:
                status = F.when(r > 0, F.lit(f"Out of range: [{_fmt(cons['min'])}, {_fmt(cons['max'])}]")) \
                    .otherwise(status)
            if enum_i:
                status = F.when(e > 0, F.lit("Invalid categorical values")).otherwise(status)
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(declared).alias("declared"),
                             F.lit(ok).alias("dtype_ok"), e.alias("n_invalid_enum"),
                             r.alias("n_out_of_range"), status.alias("status")))
    out = wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    return out.withColumn("valid", F.col("status") == "Valid")


def validate_schema(df: DataFrame, schema: dict) -> DataFrame:
    """V1-V5 + A13: (column, status, valid)."""
    return validation_checks(df, schema).select("column", "status", "valid")


def count_invalid_enum(df: DataFrame, col: str, allowed: list) -> DataFrame:
    """V3: rows whose value is NULL or outside the allowed set."""
    c = F.col(col)
    return df.agg(F.count_if(c.isNull() | ~c.isin(list(allowed))).alias("n_invalid")).withColumn("column", F.lit(col))


def count_out_of_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """V4: rows outside [lo, hi] inclusive, NULL counted as outside."""
    c = F.col(col)
    inside = F.coalesce((c >= F.lit(lo)) & (c <= F.lit(hi)), F.lit(False))
    return df.agg(F.count_if(~inside).alias("n_out_of_range")).withColumn("column", F.lit(col))


def validated_table(df: DataFrame, schema: dict) -> DataFrame:
    """V6: the table, published only when every column is valid; otherwise no rows. The verdict is a scalar
    subquery over the one-row check aggregate, so the gate stays lazy."""
    verdict = validation_checks(df, schema).agg(F.bool_and("valid").alias("all_valid"))
    return df.filter(verdict.scalar())


def invalid_value_report(df: DataFrame, schema: dict) -> DataFrame:
    """V3: every value that breaks an enum, (column, value, n_rows), NULL included; all values, one pass, counted
    map-side. Only columns whose type the schema accepts are looked at, as in ``validation_checks``."""
    parts = []
    for f in df.schema.fields:
        spec = schema.get(f.name) or {}
        allowed = (spec.get("constraints") or {}).get("enum")
        if allowed is not None and isinstance(f.dataType, LOGICAL_TYPES.get(spec.get("type"), ())):
            c = F.col(quote(f.name))
            parts.append(F.struct(F.lit(f.name).alias("column"), c.cast("string").alias("value"),
                                  (c.isNull() | ~c.isin(list(allowed))).alias("bad")))
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, value string, n_rows bigint")
    long = df.select(F.inline(F.array(*parts))).filter("bad")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def publish_validated(df: DataFrame, schema: dict, table_path: str, status_path: str) -> DataFrame:
    """V6 + S8: write the status of every column, and publish the table if all columns are valid; returns the status.
    ``table_path`` is a versioned table (``sources.versions``): a closed gate, and a write that fails midway, leave what
    was published before as it is. The status is computed once, from what it wrote."""
    validate_schema(df, schema).write.mode("overwrite").json(status_path)
    status = df.sparkSession.read.schema("column string, status string, valid boolean").json(status_path)
    if status.agg(F.bool_and("valid")).first()[0]:
        publish(df, table_path)
    return status


def check_target(df: DataFrame, target: str | list[str]) -> DataFrame:
    """V7: the target must be exactly one column of type int or bigint. Reads the schema, not the table."""
    names = [target] if isinstance(target, str) else list(target)
    single = len(names) == 1 and names[0] in df.columns
    dtype = df.schema[names[0]].dataType if single else None
    ok = isinstance(dtype, (T.IntegerType, T.LongType))
    row = (",".join(names), dtype.simpleString() if single else None, ok)
    return df.sparkSession.createDataFrame([row], "target string, dtype string, valid boolean")
