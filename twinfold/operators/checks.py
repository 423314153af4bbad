"""Schema and health checks on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules for identifiers.
ID_RULES = {"token": r"^[A-Za-z0-9]{3,64}$", "domain": r"^[a-z0-9-]+(\.[a-z0-9-]+)+$", "url": r"^https?://[^\s/]+/"}


def catalog_of(df: DataFrame) -> DataFrame:
    """(name, kind) of a DataFrame's columns."""
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema], "name string, kind string")


def catalog_of_records(rows: DataFrame, column: str) -> DataFrame:
    """(name, kind, n) of the fields that landed JSON records really hold, counted over all rows; a null has the kind void."""
    fields = rows.select(F.explode(F.try_variant_get(F.try_parse_json(column), "$", "map<string,variant>")).alias("name", "v"))
    return fields.groupBy("name", F.lower(F.schema_of_variant("v")).alias("kind")).agg(F.count("*").alias("n"))


#: Kinds that the store makes by itself and may report otherwise, and the one that stands for an unknown kind.
AUTOMATIC, UNKNOWN = ("created_time", "modified_time"), ("unknown", "void")


def schema_diff(expected: DataFrame, actual: DataFrame, automatic: tuple[str, ...] = AUTOMATIC, unknown: tuple[str, ...] = UNKNOWN) -> DataFrame:
    """One row a column that is missing, extra or of another kind. Extra columns are listed, but are no change to make.

    A column that is wanted with an automatic kind, or whose kind isn't known, is of no other kind.
    """
    both = expected.withColumnRenamed("kind", "want").join(actual.withColumnRenamed("kind", "have"), "name", "full_outer")
    issue = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "extra").when((F.col("want") != F.col("have")) & ~F.col("want").isin(*automatic) & ~F.col("have").isin(*unknown), "type_mismatch")
    return both.withColumn("issue", issue).where("issue is not null").withColumn("is_change", F.col("issue") != "extra")


def schema_apply(df: DataFrame, expected: T.StructType) -> DataFrame:
    """df with the expected columns it lacks, as nulls; nothing is dropped or retyped, so applying it twice changes nothing."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in expected if f.name not in df.columns})


def schema_invariants(catalog: DataFrame) -> DataFrame:
    """Violations in a field catalog (name, group, is_primary): repeated names, not exactly one primary."""
    twice = catalog.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_name").alias("rule"), "name", "n")
    primary = catalog.agg(F.count_if("is_primary").alias("n")).where("n <> 1").select(F.lit("one_primary").alias("rule"), F.lit("").alias("name"), "n")
    return twice.union(primary)


def field_groups(catalog: DataFrame, order: str = "pos") -> DataFrame:
    """Fields per group of a field catalog (name, group, pos): how many, and their names in order. A group is a handful of fields."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order, "name"))), lambda x: x["name"])
    return catalog.groupBy("group").agg(F.count("*").alias("n_fields"), F.min(order).alias("first"), listed.alias("fields"))


def id_violations(checked: DataFrame) -> DataFrame:
    """How many values of each ok_ column of validate_ids hold to its rule, and how many don't."""
    columns = [c for c in checked.columns if c.startswith("ok_")]
    pairs = F.explode(F.array(*[F.struct(F.lit(c.removeprefix("ok_")).alias("column"), F.col(c).alias("ok")) for c in columns])).alias("x")
    return checked.select(pairs).groupBy("x.column").agg(F.count_if("x.ok").alias("n_ok"), F.count_if(~F.col("x.ok")).alias("n_violations"))


def validate_ids(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with ok_<column> for each column and the rule it is held to; null is not ok."""
    return df.withColumns({f"ok_{c}": F.coalesce(F.col(c).rlike(ID_RULES[rule]), F.lit(False)) for c, rule in columns.items()})


def health_report(checks: DataFrame) -> DataFrame:
    """checks: name, level."""
    n = checks.agg(F.count("*").alias("n"), *[F.count_if(F.col("level") == x).alias(f"n_{x}") for x in ("ok", "info", "warning", "error")])
    return n.withColumn("passed", F.col("n_error") == 0).withColumn("summary", F.concat(F.col("n_ok").cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(" ok")))


def table_checks(spark: SparkSession, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """A check a table and key: an error if the key is null somewhere, a warning if it repeats, else ok."""
    out = None
    for name, (df, key) in tables.items():
        row = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("c")).agg(F.count_if(F.col("k").isNull()).alias("nulls"), F.count_if(F.col("c") > 1).alias("twice"))
        row = row.select(F.lit(name).alias("name"), F.when(F.col("nulls") > 0, "error").when(F.col("twice") > 0, "warning").otherwise("ok").alias("level"))
        out = row if out is None else out.union(row)
    return out
