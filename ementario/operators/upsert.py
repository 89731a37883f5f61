"""Keyed upserts without ``MERGE``: a first- or last-write rule per column.

A batch is first reduced to one row per key (partial aggregation, so a hot key never
gathers in one task), then joined to the target. The target side is only shuffled when
the reduced batch is too large to broadcast, and Spark decides that from sizes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.session import materialize

FIRST, LAST = "first", "last"


def _order(df: DataFrame, order: list[str]) -> Column:
    """A total order: the given columns, ties broken by the row's own content."""
    text = [F.col(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.struct(*[F.col(c) for c in order], F.xxhash64(*text))


def partial_state(
    df: DataFrame, keys: list[str], policy: dict[str, str], order: list[str]
) -> DataFrame:
    """Per key, the first and the last write with their place in the order.

    States of two batches combine with :func:`combine_states`, in any grouping.
    """
    first = [c for c, rule in policy.items() if rule == FIRST]
    last = [c for c, rule in policy.items() if rule == LAST]
    ranked = df.withColumn("_ord", _order(df, order))
    ord_ = F.col("_ord").alias("ord")
    aggs = []
    if first:
        aggs.append(F.min_by(F.struct(ord_, *first), "_ord").alias("_first"))
    if last:
        aggs.append(F.max_by(F.struct(ord_, *last), "_ord").alias("_last"))
    return ranked.groupBy(*keys).agg(*aggs)


def combine_states(states: DataFrame, keys: list[str]) -> DataFrame:
    aggs = []
    if "_first" in states.columns:
        aggs.append(F.min_by("_first", "_first.ord").alias("_first"))
    if "_last" in states.columns:
        aggs.append(F.max_by("_last", "_last.ord").alias("_last"))
    return states.groupBy(*keys).agg(*aggs)


def state_rows(states: DataFrame, keys: list[str], policy: dict[str, str]) -> DataFrame:
    """The table a state stands for."""
    return states.select(*keys, *[F.col(f"_{rule}.{c}").alias(c) for c, rule in policy.items()])


def collapse(df: DataFrame, keys: list[str], policy: dict[str, str], order: list[str]) -> DataFrame:
    """One row per key: each column's first or last value in ``order``, nulls included."""
    return state_rows(partial_state(df, keys, policy, order), keys, policy)


FIRST_AT, LAST_AT = "ordem_primeira", "ordem_ultima"


def collapse_wide(
    df: DataFrame, key: str, policy: dict[str, str], at: str, number: str, first_row: dict[str, Column] | None = None
) -> DataFrame:
    """One row per key, with the places of its first and last write, for rows too wide to aggregate.

    ``at`` is a column of text that orders all rows; ``number`` is a different integer in each of them and breaks ties. A key
    that comes once is its own first and last write, so only keys that are repeated have their places compared, and nothing
    but these, key and place, is aggregated. The rows that won are then found by their number: the last writes, and, of keys
    whose first write is another row, the columns that keep it. ``first_row`` names further columns, worked out from
    that other row; they are null where the first write is the last.
    """
    first, further = [c for c, rule in policy.items() if rule == FIRST], first_row or {}
    df = df.where(F.col(key).isNotNull())
    repeated = df.groupBy(key).agg(F.count("*").alias("_rows")).where("_rows > 1").select(F.col(key).alias("_key"))
    repeated = materialize(repeated, "upsert-repeated")
    if repeated.isEmpty():
        none = [F.lit(None).cast("string").alias(c) for c in further]
        return df.select(key, *policy, F.col(at).alias(FIRST_AT), F.col(at).alias(LAST_AT), *none)
    place = F.struct(F.col(at).alias("at"), F.col(number).alias("n"))
    ends = df.select(key, place.alias("_place")).join(repeated, F.col(key) == F.col("_key"), "left_semi")
    ends = ends.groupBy(key).agg(F.min("_place").alias("_first"), F.max("_place").alias("_last"))
    ends = materialize(ends, "upsert-ends").select(
        F.col(key).alias("_key"), F.col("_first.n").alias("_first_n"), F.col("_last.n").alias("_last_n"), F.col("_first.at").alias("_first_at"),
    )
    out = df.join(ends, F.col(key) == F.col("_key"), "left").where("_key IS NULL OR " + f"`{number}` = _last_n")
    out = out.withColumns({FIRST_AT: F.coalesce("_first_at", at), LAST_AT: F.col(at)}).drop("_first_n", "_key")
    if not (first or further):
        return out.select(key, *policy, FIRST_AT, LAST_AT)
    other = ends.where("_first_n <> _last_n").select(F.col("_first_n").alias("_other_n"), F.col("_key").alias("_other"))
    kept = F.struct(*first, *[c.alias(n) for n, c in further.items()])
    other = df.join(other, F.col(number) == F.col("_other_n")).select("_other", kept.alias("_first_row"))
    out = out.join(other, F.col(key) == F.col("_other"), "left")
    moved = {c: F.when(F.col("_other").isNotNull(), F.col(f"_first_row.{c}")).otherwise(F.col(c)).alias(c) for c in first}
    return out.select(key, *[moved.get(c, F.col(c)) for c in policy], FIRST_AT, LAST_AT, *[F.col(f"_first_row.{c}").alias(c) for c in further])


def merge_ordered(
    target: DataFrame, changes: DataFrame, key: str, policy: dict[str, str], derive: Callable[[DataFrame, list[str]], DataFrame] | None = None
) -> DataFrame:
    """``target`` and ``changes`` (both from :func:`collapse_wide`) as one table: per key the earliest first write and the
    latest last write, whatever the order in which loads arrive or are repeated.

    ``derive`` makes the policy's columns out of those that ``changes`` has, and keeps the columns named to it. It is applied
    after the join, so what follows from other columns is not sent along with them.
    """
    columns = [*policy, FIRST_AT, LAST_AT]
    stored = {c: f"_stored_{c}" for c in (key, *columns)}
    joined = target.select(*[F.col(c).alias(n) for c, n in stored.items()]).join(changes, F.col(stored[key]) == F.col(key), "full")
    if derive:
        joined = derive(joined, [*stored.values(), FIRST_AT, LAST_AT])
    t, c = (lambda n: F.col(stored[n])), F.col
    older = t(FIRST_AT).isNotNull() & (c(FIRST_AT).isNull() | (t(FIRST_AT) <= c(FIRST_AT)))
    newer = t(LAST_AT).isNotNull() & (c(LAST_AT).isNull() | (t(LAST_AT) > c(LAST_AT)))
    rules = {n: older if rule == FIRST else newer for n, rule in policy.items()}
    rules |= {FIRST_AT: older, LAST_AT: newer}
    return joined.select(F.coalesce(t(key), c(key)).alias(key), *[F.when(r, t(n)).otherwise(c(n)).alias(n) for n, r in rules.items()])


def changed_keys(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The keys of ``changes`` that :func:`merge_ordered` would not leave as they are in ``target``, from keys and places alone."""
    t = target.select(F.col(key).alias("_key"), F.col(FIRST_AT).alias("_first_at"), F.col(LAST_AT).alias("_last_at"))
    joined = changes.select(key, FIRST_AT, LAST_AT).join(t, F.col(key) == F.col("_key"), "left")
    same = (F.col("_first_at") <= F.col(FIRST_AT)) & (F.col("_last_at") >= F.col(LAST_AT))
    return joined.where(~F.coalesce(same, F.lit(False))).select(key)


def _same_key(a: str, b: str, keys: list[str]) -> Column:
    return reduce(
        lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    )


def merge(target: DataFrame, changes: DataFrame, keys: list[str], policy: dict[str, str]) -> DataFrame:
    """Apply ``changes`` (one row per key) to ``target`` (one row per key)."""
    t = target.select(*keys, *policy).alias("t")
    c = changes.select(*keys, *policy).withColumn("_hit", F.lit(True)).alias("c")

    def pick(name: str, rule: str) -> Column:
        if rule == FIRST:
            return F.col(f"t.{name}").alias(name)
        return F.when(F.col("c._hit"), F.col(f"c.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    updated = t.join(c, _same_key("t", "c", keys), "left").select(
        *[F.col(f"t.{k}") for k in keys], *[pick(n, r) for n, r in policy.items()]
    )
    # Which changed keys exist: semi-joining the key-only target to the small side keeps
    # the large one where it is.
    known = target.select(*keys).alias("k").join(
        changes.select(*keys).alias("q"), _same_key("k", "q", keys), "left_semi"
    )
    fresh = (
        changes.select(*keys, *policy).alias("n")
        .join(known.alias("o"), _same_key("n", "o", keys), "left_anti")
    )
    return updated.unionByName(fresh)


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], policy: dict[str, str], order: list[str]
) -> DataFrame:
    """The target after the batch; re-applying the same batch changes nothing."""
    return merge(target, collapse(batch, keys, policy, order), keys, policy)


def new_keys(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The natural keys of ``rows``, each once, that ``target`` does not hold. Both meet in one aggregate, null keys too."""
    both = rows.select(*keys, F.lit(True).alias("_new")).unionByName(target.select(*keys, F.lit(False).alias("_new")))
    return both.groupBy(*keys).agg(F.min("_new").alias("_new")).where("_new").select(*keys)


def dim_upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows whose natural key is new; nothing is changed or removed."""
    return target.select(*keys).unionByName(new_keys(target, rows, keys))


def fact_policy(columns: list[str], key: str = "id_julgado", raw: str = "teor_bruto_json") -> dict[str, str]:
    """Facts: the raw record keeps its first write, every other column its last."""
    return {c: FIRST if c == raw else LAST for c in columns if c != key}


VECTOR_POLICY = {"texto_fonte": LAST, "tipo_fonte": FIRST, "embedding": LAST}
