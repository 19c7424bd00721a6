"""Wide tables: one fact, left-joined to the dimensions around it.

A job is declared as a list of lookups, each one ``LEFT JOIN table ON table.key = role.column``. Two properties of the
result decide how it is planned:

* The wide table is stored under the fact's key, so of all copies that a one-to-many lookup makes of a fact row only
  one survives. Which one is fixed here (the smallest ids win), and the choice is made *before* the join: every lookup
  that does not go to a primary key is reduced to one row per join key, with partial aggregation ahead of the shuffle.
  A hot key therefore costs one row, and the fan-out never exists.
* A lookup then adds at most one row, so a dimension can be joined to the dimension that leads to it first, and the
  result to the fact. That is done with dimensions too large to broadcast: the fact, the largest input, is shuffled
  once per direct neighbour, not once per lookup. Small ones are joined to the fact at the end, where a broadcast adds
  no shuffle and their texts have not been shuffled either. And a lookup none of whose columns is asked for cannot
  change the result and is left out of the plan.

Broadcasts are chosen by the planner, which checks the sizes; the same size estimate decides the shape here. In a join of
two large sides the foreign keys may be skewed, with much of the fact on one key or on NULL. Adaptive execution splits
the partition of a hot key. It can do so only where both inputs are shuffled for the join, so such joins carry a second
key column: constant for real keys, it keeps the planner from reusing the partitions of the reduction above, and for NULL
keys, which match nothing, it spreads the rows over all partitions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayline.session import fits_broadcast

Tables = Callable[[str], DataFrame]

_REFERENCE = re.compile(r"\b([a-z_]\w*)\.(\w+)\b")


@dataclass(frozen=True)
class Lookup:
    """``LEFT JOIN table AS role ON role.key = to``; with ``code_type`` a slice of the code dictionary."""

    role: str
    table: str
    key: str
    to: str
    code_type: int | None = None


@dataclass(frozen=True)
class WideJob:
    """A fact with its lookups, the output columns (``role.column AS name``) and the day column."""

    name: str
    role: str
    table: str
    lookups: tuple[Lookup, ...]
    columns: tuple[str, ...]
    day: Callable[[str], Column] | None = None
    day_column: str | None = None
    key: str | None = None  # a fact column to reduce the fact on, where the result is not keyed by the fact's id
    id_role: str | None = None  # the role whose id the result is stored under, where that is not the fact

    def output(self, names: Sequence[str] | None = None) -> dict[str, str]:
        """Output name to expression, for all or some of the columns."""
        named = {}
        for text in self.columns:
            expression, _, name = text.rpartition(" AS ")
            if not expression:
                expression, name = text, text.split(".")[-1]
            named[name] = expression
        return named if names is None else {n: named[n] for n in names if n != "day"}


def one_per_key(df: DataFrame, key: str, columns: Sequence[str], order: str = "id") -> DataFrame:
    """One row per ``key``: the one with the smallest ``order``.

    One ``min_by`` per column, so that numeric columns aggregate in a hash table and each task sends at most one row
    per key.
    """
    return df.groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in columns if c != key])


def dictionary_slice(codes: DataFrame, code_type: int, code_name: str = "code",
                     text_name: str = "codeDesc") -> DataFrame:
    """One enumeration of the code dictionary."""
    return codes.where(F.col("type") == code_type).select(
        F.col("code").alias(code_name), F.col("codeDesc").alias(text_name))


def _references(expressions) -> set[tuple[str, str]]:
    return {match for text in expressions for match in _REFERENCE.findall(text)}


def _flat(text: str) -> str:
    """``role.column`` to the name that column has while the join is built."""
    return _REFERENCE.sub(r"\1__\2", text)


def _needed_lookups(job: WideJob, used: set[tuple[str, str]]) -> list[Lookup]:
    roles = {role for role, _ in used}
    kept = []
    for lookup in reversed(job.lookups):
        if lookup.role in roles:
            kept.append(lookup)
            roles.add(lookup.to.split(".")[0])
    return kept[::-1]


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def constant_key(key: str) -> Column:
    """0 for every key, in a form the optimizer does not fold."""
    return F.pmod(F.xxhash64(key), F.lit(1))


def spread_key(key: str, row: str) -> Column:
    """What ``constant_key`` gives for a row with a key; for a row without one a number above 0 that depends on ``row``."""
    return F.when(F.col(key).isNull(), F.pmod(F.xxhash64(row), F.lit(10_000)) + 1).otherwise(constant_key(key))


def widen(job: WideJob, tables: Tables, fact: DataFrame | None = None, columns: Sequence[str] | None = None,
          nested: bool = True, co_located: Mapping[str, str] | None = None) -> DataFrame:
    """Build the wide table of ``job``.

    ``columns`` picks output columns. ``nested=False`` joins every dimension straight to the fact, which is better when
    the fact is a small slice, one day for instance. ``co_located`` names the column by which a stored table lies in
    buckets: a join on it takes the dimension as it lies, and does without the means against skew, which need a shuffle.
    """
    output = job.output(columns)
    wants_day = job.day is not None and (columns is None or "day" in columns)
    used = _references(output.values())
    if wants_day:
        used |= _references([job.day_column])
    used.add((job.role, job.key or "id"))
    if job.id_role:
        used.add((job.id_role, "id"))
    lookups = _needed_lookups(job, used)
    used |= _references([lookup.to for lookup in lookups])

    def columns_of(role: str) -> list[str]:
        return sorted(c for r, c in used if r == role)

    fact = tables(job.table) if fact is None else fact
    if job.key:
        fact = one_per_key(fact, job.key, columns_of(job.role))
    base = fact.select([F.col(c).alias(f"{job.role}__{c}") for c in columns_of(job.role)])

    sources = {job.role: job.table} | {lookup.role: lookup.table for lookup in lookups}

    def dimension(lookup: Lookup) -> DataFrame:
        df = tables(lookup.table)
        key = F.col(lookup.key)
        role, column = lookup.to.split(".")
        if _is_text(df, lookup.key) and not _is_text(tables(sources[role]), column):
            key = key.try_cast("bigint")  # a code that is no number matches nothing
        if lookup.code_type is not None:
            df = df.where(F.col("type") == lookup.code_type)
        wanted = columns_of(lookup.role)
        df = df.select(key.alias("_key"), *dict.fromkeys(["id", *wanted]))
        if lookup.key != "id":
            df = one_per_key(df, "_key", wanted)
        return df.select(F.col("_key").alias(f"{lookup.role}___key"),
                         *[F.col(c).alias(f"{lookup.role}__{c}") for c in wanted])

    def attach(left: DataFrame, lookup: Lookup, row: str) -> DataFrame:
        target, key = _flat(lookup.to), f"{lookup.role}___key"
        right = attach_large(dimension(lookup), lookup.role, key)
        found = F.col(target) == F.col(key)
        if lookup in large and (co_located or {}).get(lookup.table) != lookup.key:
            found = found & (spread_key(target, row) == constant_key(key))
        return left.join(right, found, "left").drop(key)

    def attach_large(df: DataFrame, role: str, row: str) -> DataFrame:
        """Join the large neighbours of a role; those with the same foreign key follow each other and share a shuffle."""
        neighbours = [lookup for lookup in large if lookup.to.split(".")[0] == role]
        targets = [lookup.to for lookup in neighbours]
        for lookup in sorted(neighbours, key=lambda n: targets.index(n.to)):
            df = attach(df, lookup, row)
        return df

    small = {name: fits_broadcast(tables(name)) for name in {lookup.table for lookup in lookups}} if nested else {}
    large = [lookup for lookup in lookups if not small.get(lookup.table, True)]
    row = f"{job.role}__{job.key or 'id'}"
    joined = attach_large(base, job.role, row)
    for lookup in lookups:
        if lookup not in large:
            joined = attach(joined, lookup, row)

    if job.id_role:
        joined = joined.where(F.col(f"{job.id_role}__id").isNotNull())
    selected = [F.expr(_flat(expression)).alias(name) for name, expression in output.items()]
    if wants_day:
        selected.append(job.day(_flat(job.day_column)).alias("day"))
    return joined.select(selected)
