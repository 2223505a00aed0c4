"""Row identity, sampling and row order.

Draws are decided per row by a key: 60 bits of the MD5 of ``seed:id``, so that
any engine can recompute them. Ids come with the landed tables (see
``sources.landing``); only a table without ids is written with some first.

The k smallest keys of a table, or of every class of it, are found by
narrowing: counts per 15 leading bits of the key (combined map-side) give the
range that holds the k-th, the next pass counts inside it. Four light passes
over the id column at most, whatever the size; no row is moved or written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions import exprs as X

ROW_ID = "_row_id"
KEY_BITS, DIGIT_BITS = 60, 15


def with_row_id(df: DataFrame) -> DataFrame:
    """``df`` with a unique id per row, for tables that were landed without
    ids: its place in the order of a content hash, from written range
    partitions. Equal rows get ids of their own, and the same rows get the
    same ids however they are partitioned."""
    from lendlens.operators.window import global_row_number
    keyed = df.withColumn("_h", X.content_hash(df)).withColumn("_m", F.monotonically_increasing_id())
    return global_row_number(keyed, [F.col("_h"), F.col("_m")], name=ROW_ID).drop("_h", "_m")


def draw_key(id_col: str, seed: int) -> Column:
    """The row's key, uniform over ``2 ** KEY_BITS``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_col}`").cast("string")))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def drawn(id_col: str, seed: int, fraction: float) -> Column:
    """True for a ``fraction`` of the ids."""
    return draw_key(id_col, seed) < int(fraction * (1 << KEY_BITS))


def smallest_keys(df: DataFrame, id_col: str, seed: int, wanted: Mapping | int, group: str | None = None) -> Column:
    """A condition that holds for exactly the ``wanted`` rows of smallest key
    (ties: smallest id), per value of ``group`` if given.

    A group with no more rows than wanted is taken whole. Ids are unique."""
    wanted = dict(wanted) if isinstance(wanted, Mapping) else {None: int(wanted)}
    g = F.col(f"`{group}`") if group else F.lit(None)
    keyed = df.select(g.alias("g"), draw_key(id_col, seed).alias("key"), F.col(f"`{id_col}`").alias("id"))
    # per group: rows still wanted, and the leading digits that the last of them has
    need, prefix, shift = dict(wanted), {k: 0 for k in wanted}, KEY_BITS
    whole = {k for k, n in wanted.items() if n <= 0}
    while shift and len(whole) < len(wanted):
        inside = F.lit(False)
        for k in wanted:
            if k not in whole:
                inside |= g_is("g", k) & (F.shiftright("key", shift) == prefix[k])
        shift -= DIGIT_BITS
        digit = F.shiftright("key", shift).bitwiseAND((1 << DIGIT_BITS) - 1)
        rows = keyed.filter(inside).groupBy("g", digit.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()  # 2^15 per group at most
        for k in wanted:
            if k in whole:
                continue
            own = sorted((r["d"], r["n"]) for r in rows if r["g"] == k)
            for d, n in own:
                if n >= need[k]:
                    prefix[k] = (prefix[k] << DIGIT_BITS) + d
                    break
                need[k] -= n
            else:
                whole.add(k)  # fewer rows than wanted
    out = F.lit(False)
    for k, n in wanted.items():
        if k in whole:
            out |= g_is(group, k) & F.lit(n > 0)
            continue
        key = draw_key(id_col, seed)
        # equal keys are equal ids but for an MD5 collision: a row or two
        last = [r["id"] for r in keyed.filter(g_is("g", k) & (F.col("key") == prefix[k])).select("id").orderBy("id").limit(need[k]).collect()]
        out |= g_is(group, k) & ((key < prefix[k]) | ((key == prefix[k]) & F.col(f"`{id_col}`").isin(last)))
    return out


def g_is(col: str | None, value) -> Column:
    if col is None or (col == "g" and value is None):
        return F.lit(True)
    return F.col(f"`{col}`").eqNullSafe(F.lit(value))


def sample_at_most(df: DataFrame, max_rows: int, seed: int = 42, id_col: str | None = None) -> DataFrame:
    """A seeded sample of exactly ``min(count, max_rows)`` rows, uniform
    also among equal rows. ``id_col`` names a unique id; without one the rows
    are written with ids once."""
    own = df if id_col else with_row_id(df)
    taken = own.filter(smallest_keys(own, id_col or ROW_ID, seed, max_rows))
    return taken.select(*[F.col(f"`{c}`") for c in df.columns])


def shuffled(df: DataFrame, seed: int = 42, id_col: str | None = None) -> DataFrame:
    """R2: a seeded random row order — only meaningful for an export, since
    Spark rows carry no order between operators."""
    return df.orderBy(draw_key(id_col, seed) if id_col else F.rand(seed))


def split_sizes(counts: Sequence[int], n_draws: int) -> list[int]:
    """Integer split of ``n_draws`` over classes in proportion to ``counts``:
    floors first, the rest to the largest remainders (ties: class order)."""
    total = sum(counts)
    shares = [c / total * n_draws if total else 0.0 for c in counts]
    out = [int(x) for x in shares]
    for i in sorted(range(len(counts)), key=lambda i: (out[i] - shares[i], i))[: n_draws - sum(out)]:
        out[i] += 1
    return out
