"""Constraints that hold: a load is checked while it is written, and published only if nothing breaks a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ementario.operators.quality import fk_violations
from ementario.operators.star import current_table
from ementario.schemas import DIM_PARTITION
from ementario.session import scratch_path


@dataclass(frozen=True)
class Rules:
    """What every row of a table must satisfy. ``foreign`` maps a column to a parent's keys, a table of one column."""

    not_null: Sequence[str] = ()
    widths: Mapping[str, int] = field(default_factory=dict)
    vector_dims: Mapping[str, int] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()
    foreign: Mapping[str, DataFrame] = field(default_factory=dict)


def row_rules(rules: Rules) -> dict[str, Column]:
    """Rules that one row breaks or keeps by itself, as conditions of breaking them."""
    return {
        **{f"not null {c}": F.col(c).isNull() for c in rules.not_null},
        **{f"width {c}": F.char_length(F.col(c)) > n for c, n in rules.widths.items()},
        **{f"dimension {c}": F.col(c).isNull() | (F.size(F.col(c)) != n) for c, n in rules.vector_dims.items()},
    }


def key_violations(written: DataFrame, published: DataFrame | None, rules: Rules) -> dict[str, int]:
    """Rows with a key that another row of the load, or the table, has already, and rows whose parent is missing.

    Only key columns are read. A key is counted with map-side partials, so one that is repeated very often is no hot group. Keys
    with a null part break no rule, as in SQL.
    """
    found = {}
    for keys in rules.unique:
        name = f"unique {', '.join(keys)}"
        whole = written.dropna(subset=list(keys))
        inside = whole.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").agg(F.sum(F.col("n") - 1).alias("n")).first()["n"] or 0
        again = 0 if published is None else whole.select(*keys).distinct().join(published.select(*keys), list(keys), "left_semi").count()
        found[name] = inside + again
    for column, parents in rules.foreign.items():
        found[f"foreign {column}"] = fk_violations(written.select(column), column, parents, parents.columns[0]).count()
    return found


def guarded_load(
    spark: SparkSession, rows: DataFrame, name: str, root: str, load_id: str, rules: Rules
) -> dict[str, int]:
    """Write a load, count what breaks a rule while it is written, and publish it as a partition of the table if nothing does.

    Gives the rules that were broken, with how many rows did. Such a load stays unpublished in its folder below ``root``;
    it and its counts are entered in the table's ``{name}_violacoes`` folder. A repeated load replaces its own partition
    and is not compared with itself. The rows are computed and written once; keys are then checked from the
    written files, so what is published is what was checked.
    """
    part = f"load-{load_id}"  # never reads as a number, so the partition value stays text
    path = f"{root}/{name}-{part}-{scratch_path(spark, 'guard').rsplit('-', 1)[1]}"
    conditions = row_rules(rules)
    seen = Observation()
    watched = rows.observe(seen, F.count("*").alias("rows"), *(F.count_if(c).alias(r) for r, c in conditions.items()))
    watched.write.parquet(path)
    broken = {r: n for r, n in seen.get.items() if r != "rows"}
    old = current_table(spark, name)
    others = None if old is None else old.filter(F.col(DIM_PARTITION) != part)
    broken |= key_violations(spark.read.schema(rows.schema).parquet(path), others, rules)
    broken = {r: int(n) for r, n in broken.items() if n}
    if broken:
        entries = [(load_id, r, n, path) for r, n in broken.items()]
        spark.createDataFrame(entries, "load string, rule string, n long, folder string").write.mode("append").parquet(f"{root}/{name}_violacoes")
        return broken
    if old is None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}, {DIM_PARTITION} string) USING parquet PARTITIONED BY ({DIM_PARTITION}) LOCATION '{root}/{name}'")
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({DIM_PARTITION}='{part}') LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} PARTITION ({DIM_PARTITION}='{part}') SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return {}
