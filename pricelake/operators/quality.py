"""Data-quality and report operators (A1, A4-A13, Q-1..Q-10, O2, O3, S14).

Every check returns a DataFrame; severity is a column. Totals are scalar subqueries (``DataFrame.scalar()``),
evaluated once by Spark, never pulled through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.text import _col, pct

OK, WARN, ERROR = "OK", "WARN", "ERROR"


def _count() -> Column:
    return F.count(F.lit(1)).cast("long")


# ----------------------------------------------------------------------------------------------------- A1, U0, S14
def table_counts(tables: Mapping[str, DataFrame], name_col: str = "table_name", count_col: str = "row_count") -> DataFrame:
    """One row per table with its row count (a UNION ALL of one aggregate per table)."""
    parts = [df.agg(_count().alias(count_col)).select(F.lit(n).alias(name_col), count_col) for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def catalog_report(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Table inventory: exists, row count, column count and the column list (``None`` = missing table)."""
    meta = [
        (n, df is not None, len(df.columns) if df is not None else 0, ", ".join(sorted(df.columns)) if df is not None else "")
        for n, df in tables.items()
    ]
    schema = "table_name string, table_exists boolean, column_count int, columns string"
    info = spark.createDataFrame(meta, schema)
    present = {n: df for n, df in tables.items() if df is not None}
    if not present:
        return info.withColumn("row_count", F.lit(None).cast("long"))
    return info.join(table_counts(present), "table_name", "left")


def schema_check(df: DataFrame | None, table: str, required: Sequence[str] = (), forbidden: Sequence[str] = ()) -> DataFrame:
    """Q-7: table exists, required columns present, forbidden legacy columns absent."""
    cols = set(df.columns) if df is not None else set()
    missing = sorted(set(required) - cols)
    present_forbidden = sorted(set(forbidden) & cols)
    status = ERROR if df is None or missing else (WARN if present_forbidden else OK)
    from pyspark.sql import SparkSession as _S

    spark = df.sparkSession if df is not None else _S.getActiveSession()
    return spark.createDataFrame(
        [(table, df is not None, ", ".join(missing), ", ".join(present_forbidden), status)],
        "table_name string, table_exists boolean, missing_columns string, forbidden_columns string, status string",
    )


# ------------------------------------------------------------------------------------------------------ A4, A5, A6
def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: NULL counts of columns and the NULL share of the first one, plus the total (one pass)."""
    aggs = [F.count_if(F.col(c).isNull()).cast("long").alias(f"null_{c}") for c in cols]
    out = df.agg(*aggs, _count().alias("total_rows"))
    return out.withColumn(f"pct_null_{cols[0]}", pct(f"null_{cols[0]}", "total_rows"))


def share_of_total(df: DataFrame, group: Sequence[str] | str, count_col: str = "n", pct_col: str = "pct") -> DataFrame:
    """A5: group count and its share of the grand total, 2 decimals (the total is a scalar subquery)."""
    group = [group] if isinstance(group, str) else list(group)
    total = df.select(_count()).scalar()
    return df.groupBy(*group).agg(_count().alias(count_col)).withColumn(pct_col, pct(count_col, total))


def match_report(df: DataFrame, id_col: str) -> DataFrame:
    """Total, matched, unmatched, success rate (matched = id not NULL)."""
    return df.agg(
        _count().alias("total_rows"),
        F.count_if(F.col(id_col).isNotNull()).cast("long").alias("matched_rows"),
        F.count_if(F.col(id_col).isNull()).cast("long").alias("unmatchable_rows"),
    ).withColumn("success_rate", pct("matched_rows", "total_rows"))


# ----------------------------------------------------------------------------------------------------- A7, A9, A10
def profile_by(
    df: DataFrame, group: str, measure: str, year: str, ref: str, null_label: str = "(NULL)", digits: int = 6
) -> DataFrame:
    """Per group: rows, distinct years, distinct references, min/max/avg of the measure (rounded to
    ``digits``); the NULL group is labelled."""
    g = F.coalesce(F.col(group).cast("string"), F.lit(null_label)).alias(group)
    m = F.col(measure).cast("double")
    return df.groupBy(g).agg(
        _count().alias("n_rows"),
        F.count_distinct(year).cast("long").alias("n_years"),
        F.count_distinct(ref).cast("long").alias("n_refs"),
        F.round(F.min(m), digits).alias("min_value"),
        F.round(F.max(m), digits).alias("max_value"),
        F.round(F.avg(m), digits).alias("avg_value"),
    )


def year_coverage(facts: Mapping[str, DataFrame], year: str) -> DataFrame:
    """A10: per fact table: rows, distinct years, first and last year."""
    out = None
    for name, df in facts.items():
        part = df.agg(
            _count().alias("n_rows"),
            F.count_distinct(year).cast("long").alias("n_years"),
            F.min(year).alias("min_year"),
            F.max(year).alias("max_year"),
        ).select(F.lit(name).alias("fact"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def level_coverage(df: DataFrame, levels: Mapping[str, Column], ref: str) -> DataFrame:
    """Coverage per geographic level: rows and distinct references among the rows of each level, all levels
    in one scan (conditional aggregates), then stacked into rows."""
    aggs, parts = [], []
    for i, (name, cond) in enumerate(levels.items()):
        aggs += [F.count_if(cond).cast("long").alias(f"n{i}"), F.count_distinct(F.when(cond, F.col(ref))).cast("long").alias(f"r{i}")]
        parts.append(f"'{name}', n{i}, r{i}")
    wide = df.agg(*aggs)
    return wide.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (level, n_rows, n_refs)")


# ------------------------------------------------------------------------------------------------------------- A8
def hierarchy_counts(root: DataFrame, root_key: str, levels: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Distinct members of each level under each root. levels, from the top: (name, table, own key, parent's key).
    Each level is reduced to distinct (own key, parent's key), mapped to its roots once and counted at its own table;
    ``n_<name>`` is 0 where a root has none."""
    out = root
    above = root.select(F.col(root_key).alias("__k"), F.col(root_key).alias("__root"))
    for name, table, key, parent in levels:
        own = table.select(F.col(key).alias("__own"), F.col(parent).alias("__k")).where(F.col("__own").isNotNull()).distinct()
        above = own.join(above, "__k").select(F.col("__own").alias("__k"), "__root").distinct()
        counts = above.groupBy(F.col("__root").alias(root_key)).agg(_count().alias(f"n_{name}"))
        out = out.join(counts, root_key, "left").withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0)).cast("long"))
    return out


# -------------------------------------------------------------------------------------------------------- A12, Q-1
def fk_orphans(child: DataFrame, keys: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Q-1: per foreign key (``fk``, parent, parent's key, name of the check): rows, rows with a NULL key, rows whose key
    is set but absent from the parent, and a verdict: orphans -> WARN; empty child -> WARN; else OK. Totals and NULLs of
    all keys come from one aggregate; each key then takes one anti join."""
    aggs, stacked = [_count().alias("__n")], []
    for i, (fk, _, _, name) in enumerate(keys):
        aggs.append(F.count_if(F.col(fk).isNull()).cast("long").alias(f"__null{i}"))
        stacked.append(f"'{name}', __n, __null{i}")
    base = child.agg(*aggs).selectExpr(f"stack({len(keys)}, {', '.join(stacked)}) as (check_name, total_rows, null_fk)")
    parts = base.withColumn("orphans", F.lit(0).cast("long"))
    for fk, parent, pk, name in keys:
        own = child.select(fk).where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
        zero = F.lit(0).cast("long")
        parts = parts.unionByName(own.agg(_count().alias("orphans")).select(F.lit(name).alias("check_name"), zero.alias("total_rows"), zero.alias("null_fk"), "orphans"))
    sums = parts.groupBy("check_name").agg(*[F.sum(c).alias(c) for c in ("total_rows", "null_fk", "orphans")])
    verdict = F.when((F.col("orphans") > 0) | (F.col("total_rows") == 0), F.lit(WARN)).otherwise(F.lit(OK))
    return sums.select("check_name", "total_rows", "null_fk", "orphans", verdict.alias("status"))


def level_fk_check(df: DataFrame, level_col: str, required_fk: Mapping[str, str]) -> DataFrame:
    """Per level: rows and rows missing the FK that level requires, all levels in one scan (``count_if``
    per condition), then stacked into rows."""
    aggs, parts = [], []
    for i, (level, fk) in enumerate(required_fk.items()):
        is_level = F.col(level_col) == level
        aggs += [F.count_if(is_level).cast("long").alias(f"n{i}"), F.count_if(is_level & F.col(fk).isNull()).cast("long").alias(f"m{i}")]
        parts.append(f"'{level}', '{fk}', n{i}, m{i}")
    wide = df.agg(*aggs)
    out = wide.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (level, fk, n_rows, missing_fk)")
    return out.withColumn("status", F.when(F.col("missing_fk") > 0, F.lit(WARN)).otherwise(F.lit(OK)))


# ---------------------------------------------------------------------------------------------------- Q-2, Q-3, Q-4
def health_check(counts: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Q-2: required tables must be non-empty (ERROR), optional ones warn when empty (F12: CASE-style flags)."""
    c = counts.where(F.col("table_name").isin(list(required) + list(optional)))
    is_req = F.col("table_name").isin(list(required))
    ok = F.col("row_count") > 0
    status = F.when(ok, F.lit(OK)).when(is_req, F.lit(ERROR)).otherwise(F.lit(WARN))
    return c.select("table_name", "row_count", is_req.alias("required"), ok.alias("has_rows"), status.alias("status"))


def threshold_check(counts: DataFrame, minimums: Mapping[str, int], severity: str = WARN) -> DataFrame:
    """Q-3/Q-4: row counts against minimum thresholds (joined to a threshold table)."""
    spark = counts.sparkSession
    th = spark.createDataFrame([(k, int(v)) for k, v in minimums.items()], "table_name string, min_rows long")
    j = th.join(counts, "table_name", "left").withColumn("row_count", F.coalesce(F.col("row_count"), F.lit(0)).cast("long"))
    status = F.when(F.col("row_count") >= F.col("min_rows"), F.lit(OK)).otherwise(F.lit(severity))
    return j.select("table_name", "row_count", "min_rows", status.alias("status"))


def require_rows(counts: DataFrame, tables: Sequence[str]) -> None:
    """Q-4 raise option: fail the job when any listed table is empty."""
    empty = counts.where(F.col("table_name").isin(list(tables)) & (F.col("row_count") == 0)).select("table_name")
    names = [r[0] for r in empty.collect()]  # at most len(tables) rows
    if names:
        raise ValueError(f"empty tables: {', '.join(sorted(names))}")


# ------------------------------------------------------------------------------------------------------- Q-5, Q-6
def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q-5: natural-key groups with more than one row; NULLs compare equal (GROUP BY is null-safe)."""
    return df.groupBy(*keys).agg(_count().alias("n_rows")).where(F.col("n_rows") > 1)


def row_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Q-6: violation count per boolean row rule (a rule holds when the expression is true)."""
    aggs = [F.count_if(~F.coalesce(cond, F.lit(False))).cast("long").alias(n) for n, cond in rules.items()]
    wide = df.agg(_count().alias("total_rows"), *aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n in rules)
    return wide.selectExpr("total_rows", f"stack({len(rules)}, {stack}) as (rule_name, violations)").select(
        "rule_name", "violations", "total_rows", F.when(F.col("violations") > 0, F.lit(WARN)).otherwise(F.lit(OK)).alias("status")
    )


def exactly_one(*cols: Column | str) -> Column:
    """Row rule: exactly one of the columns is set."""
    n = None
    for c in cols:
        x = _col(c).isNotNull().cast("int")
        n = x if n is None else n + x
    return n == 1


def at_least_one(*cols: Column | str) -> Column:
    """Row rule: at least one measure is set."""
    out = None
    for c in cols:
        out = _col(c).isNotNull() if out is None else out | _col(c).isNotNull()
    return out


# ------------------------------------------------------------------------------------------------------------- Q-8
def run_snapshot(run_id: str, counts: DataFrame) -> DataFrame:
    """Q-8: one row per run: run id, UTC stamp, the counts as ``map<string,bigint>`` (write it with ``write.json``)."""
    return counts.agg(F.map_from_entries(F.collect_list(F.struct("table_name", "row_count"))).alias("counts")).select(
        F.lit(run_id).alias("run_id"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"), "counts"
    )


# -------------------------------------------------------------------------------------------------------- O2, O3
def ordered_sample(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """O2/O3: ordered TOP-n (TakeOrderedAndProject: each task keeps n rows, the driver merges n per task)."""
    return df.orderBy(*order).limit(n)


def sample_with(
    df: DataFrame, order: Sequence[Column], dims: Sequence[tuple[DataFrame, str, str, Sequence[str]]], n: int = 10
) -> DataFrame:
    """O2 with look-ups: the ordered TOP-n, left-joined to each (dimension, its key, fact key, columns) and in order again.
    A dimension is first reduced to the keys of the sample, at most ``n``, which are broadcast."""
    out = top = ordered_sample(df, order, n)
    for dim, key, fk, take in dims:
        wanted = F.broadcast(top.select(F.col(fk).alias(key)).distinct())
        out = out.join(dim.select(key, *take).join(wanted, key, "left_semi").withColumnRenamed(key, fk), fk, "left")
    return out.orderBy(*order)
