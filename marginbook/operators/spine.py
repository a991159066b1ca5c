"""Bringing several fact components onto one key spine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from ..functions.measures import money_sql, sums


def key_spine(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys of all frames; repeats are removed before the shuffle."""
    out = None
    for df in frames:
        part = df.select(*keys)
        out = part if out is None else out.unionAll(part)
    return out.distinct()


def spine_merge(frames: Mapping[str, tuple[DataFrame, Sequence[str]]], keys: Sequence[str],
                scale: int = 2, masks: Sequence[str] = (), fine: bool = False, dealt: Mapping[str, str] | None = None) -> DataFrame:
    """Sum every component's measures on the union of all keys.

    ``frames`` maps a prefix to ``(frame, measures)``; output columns are ``prefix_measure``. The
    frames may be rows or already summed; NULL key parts match. Columns named in ``masks`` (one per component) are bit masks, merged by OR.

    Components are summed narrow and widened after: stacked with a tag and as many unnamed columns as the largest component has
    measures, summed per key and tag with partial sums before the shuffle, and only the sums of a key, one row per component, are dealt
    by key and spread to the named columns. Neither shuffle carries the columns of the other components.

    Where the named columns are at most twice as many as the unnamed ones, they are summed at once: one shuffle, behind partial sums.

    ``fine`` is for many columns under keys nearly as fine as the rows (an account's fills of one contract and day), where sums before a
    shuffle fill memory and save nothing: the rows go to their key as they are, in one shuffle, and are summed there. ``dealt`` names
    what they are dealt by instead of the whole key, SQL over the keys; the result has these columns, too, and stays dealt by them, so
    a join on them (with `spread`) moves no wide row.
    """
    own = {p: [m for m in ms if f"{p}_{m}" not in masks] for p, (_, ms) in frames.items()}
    bits = {p: [m for m in ms if f"{p}_{m}" in masks] for p, (_, ms) in frames.items()}
    if any(len(m) > 1 for m in bits.values()):
        raise ValueError("a component may have one bit mask")
    width, masked = max(map(len, own.values())), any(bits.values())
    stacked, place = None, {}
    for tag, (prefix, (df, measures)) in enumerate(frames.items()):
        slots = [*own[prefix], *["NULL"] * (width - len(own[prefix]))]
        mask = [f"CAST({bits[prefix][0] if bits[prefix] else 'NULL'} AS BIGINT) AS __bits"] if masked else []
        part = df.selectExpr(*keys, f"{tag} AS __part", *[f"CAST({m} AS DOUBLE) AS __m{i}" for i, m in enumerate(slots)], *mask)
        stacked = part if stacked is None else stacked.unionAll(part)
        place |= {f"{prefix}_{m}": (tag, "__bits" if m in bits[prefix] else f"__m{own[prefix].index(m)}") for m in measures}
    if fine or len(place) <= 2 * width:
        def total(tag: int, slot: str) -> str:
            part = f"CASE WHEN __part = {tag} THEN {slot} END"
            return f"coalesce({f'bit_or({part})' if slot == '__bits' else money_sql(part, scale)}, 0)"
        by = dealt or {k: k for k in keys}
        rows = stacked.repartition(*map(F.expr, by.values())) if fine else stacked
        return rows.groupBy(*keys, *[F.expr(e).alias(n) for n, e in by.items() if n not in keys]).agg(
            *[F.expr(f"{total(*at)} AS {name}") for name, at in place.items()])
    narrow = stacked.groupBy(*keys, "__part").agg(
        *sums([f"__m{i}" for i in range(width)], scale), *([F.expr("coalesce(bit_or(__bits), 0) AS __bits")] if masked else []))
    return narrow.repartition(*keys).groupBy(*keys).agg(
        *[F.expr(f"coalesce(sum(CASE WHEN __part = {tag} THEN {slot} END), 0) AS {name}") for name, (tag, slot) in place.items()])


def spread(df: DataFrame, cell: str, cells: int) -> DataFrame:
    """Every row once in each cell: the side of a join that is narrow, for rows dealt by a key and a cell of their other keys.

    A frequent key's rows then lie in as many tasks as there are cells, and rows dealt like that are joined where they are. This
    side is hashed, so the wide one is not sorted either.
    """
    return df.withColumn(cell, F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))).hint("shuffle_hash")


def union_all(frames: Sequence[DataFrame], by_position: bool = False) -> DataFrame:
    """UNION ALL by name (case-insensitive), or by position for frames that only share arity."""
    out = frames[0]
    for df in frames[1:]:
        if by_position:
            out = out.union(df)
        else:
            spelled = {c.lower(): c for c in out.columns}
            out = out.unionByName(df.toDF(*[spelled.get(c.lower(), c) for c in df.columns]),
                                  allowMissingColumns=True)
    return out
