"""Key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.functions.columns import as_list, require_columns
from sediment.operators.skew import aggregate_by_key, lookup_join
from sediment.session import materialise


def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = df.select(*[F.col(f"`{key}`") for key in keys])
    return aggregate_by_key(rows, keys, F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row, nulls equal, with the number of rows."""
    keys = as_list(keys)
    require_columns({"table": df}, keys, "key columns")
    return _counted(df, keys).where("n > 1")


def primary_key_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that repeat or contain a null, with the rule broken and the number of rows."""
    keys = as_list(keys)
    require_columns({"table": df}, keys, "key columns")
    has_null = reduce(lambda a, b: a | b, [F.col(f"`{key}`").isNull() for key in keys])
    counted = _counted(df, keys)
    rule = F.when(has_null, "null").when(F.col("n") > 1, "duplicate")
    return counted.withColumn("rule", rule).where(F.col("rule").isNotNull())


def orphans(child: DataFrame, parent: DataFrame, references: Mapping[str, str]) -> DataFrame:
    """Child rows whose key has no parent. As in SQL, a key with a null refers to nothing."""
    columns = list(references)
    known = parent.select(*[F.col(f"`{target}`").alias(column) for column, target in references.items()])
    return lookup_join(child.dropna(subset=columns), known, columns, "left_anti").select(*child.columns)


def foreign_key_violations(child: DataFrame, parent: DataFrame, references: Mapping[str, str]) -> DataFrame:
    """Missing parent keys with the number of child rows that name them.

    Where both sides have the same types, one aggregate over the rows of both tells counts
    and parents: nothing is sorted or joined. A key named by very many rows is counted per
    task first.
    """
    columns = list(references)
    named = child.dropna(subset=columns).select(*[F.col(f"`{column}`") for column in columns])
    known = parent.select(*[F.col(f"`{target}`").alias(column) for column, target in references.items()])
    if [named.schema[c].dataType for c in columns] != [known.schema[c].dataType for c in columns]:  # a join makes them alike
        return _counted(named, columns).join(known, columns, "left_anti").select(*columns, "n")
    rows = named.withColumn("_known", F.lit(False)).unionByName(known.dropna().withColumn("_known", F.lit(True)))
    measures = [F.count_if(~F.col("_known")).alias("n"), F.bool_or("_known").alias("_known")]
    counted = aggregate_by_key(rows, columns, *measures)
    return counted.where(~F.col("_known")).select(*columns, "n")


@dataclass(frozen=True)
class PrimaryKey:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    table: str
    parent: str
    references: tuple[tuple[str, str], ...]


def check_keys(tables: Mapping[str, DataFrame], constraints: Sequence[PrimaryKey | ForeignKey]) -> DataFrame:
    """One report over all declared keys: table, rule, key as JSON, number of rows."""

    def report(constraint: PrimaryKey | ForeignKey) -> DataFrame:
        if isinstance(constraint, PrimaryKey):
            columns = constraint.columns
            found = primary_key_violations(tables[constraint.table], columns)
            rule = F.concat(F.lit("primary key: "), F.col("rule"))
        else:
            columns = [column for column, _ in constraint.references]
            found = foreign_key_violations(
                tables[constraint.table], tables[constraint.parent], dict(constraint.references)
            )
            rule = F.lit(f"foreign key: {constraint.parent}")
        key = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        return found.select(F.lit(constraint.table).alias("table_name"), rule.alias("rule"), key.alias("key"), "n")

    return reduce(DataFrame.unionByName, [report(constraint) for constraint in constraints])


class KeyViolation(ValueError):
    """A declared key does not hold; ``report`` has every violation."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def enforce_keys(tables: Mapping[str, DataFrame], constraints: Sequence[PrimaryKey | ForeignKey]) -> None:
    """Fail when any declared key is broken.

    The error names a few of the rows and carries the whole report, which is written to
    the shared folder.
    """
    if not constraints:
        return
    report = materialise(check_keys(tables, constraints), "key-report")
    few = report.take(5)
    if few:
        named = "; ".join(f"{r.table_name}: {r.rule} {r.key} ({r.n} rows)" for r in few)
        raise KeyViolation(f"{named}; all in {report.inputFiles()[0].rpartition('/')[0]}", report)
