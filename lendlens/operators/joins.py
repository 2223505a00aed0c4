"""Joins with dimension tables (J1–J7) and dimension dedup.

Sizes are measured, not guessed: ``measured`` adds up rows and bytes in one
aggregate (one row a task; text and binary columns by their real lengths).
``lookup_join`` broadcasts a side only when its measured bytes are within the
bound; a dimension meeting more facts than that is thinned first by a Bloom
filter of the facts' keys, before any of its rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcast ceilings: at most this many rows AND this many measured bytes. A
# broadcast table is copied to every executor, so the byte bound is what keeps
# it cheap on a 1000-executor cluster.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

# Bloom filter: blocks of 32,768 bits (what one bitmap aggregate holds), four
# bits a key inside one block, at least ten bits of filter a key. With more keys
# than the largest filter serves, the join goes without one.
BLOCK_BITS = 32_768
KEY_BITS = 4
BITS_PER_KEY = 10
MAX_BLOCKS = BROADCAST_MAX_BYTES * 8 // BLOCK_BITS


def _type_bytes(dt: T.DataType) -> int:
    """Bytes of a value of a type of fixed width."""
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    if isinstance(dt, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    return 8


class Size(NamedTuple):
    rows: int
    bytes: int


def _value_bytes(name: str, dt: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return F.lit(_type_bytes(dt))


def measured(df: DataFrame) -> Size:
    """Rows of ``df`` and their bytes in memory, by one aggregate: each task
    sends one row. Hand in a scan or a written table; anything else is computed
    once for the measurement and again by its user."""
    row = sum((_value_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(16))
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("long")).alias("b")).first()
    return Size(got["n"], got["b"] or 0)


def fits(size: Size, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when a table of that size may be broadcast."""
    return size.rows <= max_rows and size.bytes <= BROADCAST_MAX_BYTES


def _bloom_place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block and its bits in there."""
    bits = F.xxhash64(key, F.lit(1))
    return (F.pmod(F.xxhash64(key), F.lit(blocks)),
            [F.shiftrightunsigned(bits, 15 * k).bitwiseAND(BLOCK_BITS - 1) for k in range(KEY_BITS)])


class Bloom(NamedTuple):
    table: DataFrame  # (_block, _bits)
    blocks: int


def bloom_filter(keys: DataFrame, key: str, n_keys: int) -> Bloom | None:
    """Blocked Bloom filter of a key column: one bitmap aggregate, combined in
    the tasks. ``None`` when ``n_keys`` keys need more than ``MAX_BLOCKS`` blocks
    (64 MiB)."""
    blocks = max(1, -(-n_keys * BITS_PER_KEY // BLOCK_BITS))
    if blocks > MAX_BLOCKS:
        return None
    block, bits = _bloom_place(F.col(f"`{key}`"), blocks)
    table = (keys.filter(F.col(f"`{key}`").isNotNull())
             .select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit"))
             .groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits")))
    return Bloom(table, blocks)


def bloom_keep(df: DataFrame, key: str, bloom: Bloom) -> DataFrame:
    """Rows whose key may be in the filter: all that are, and about one in a
    hundred of the others. The filter (at most 64 MiB) is broadcast; no row of
    ``df`` moves, so a hot key stays spread over its input splits."""
    block, bits = _bloom_place(F.col(f"`{key}`"), bloom.blocks)

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.col("_bits").substr(F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
        return F.getbit(byte.cast("int"), bit.bitwiseAND(7).cast("int")) == 1

    hit = is_set(bits[0])
    for bit in bits[1:]:
        hit = hit & is_set(bit)
    return (df.withColumn("_at", block)
            .join(F.broadcast(bloom.table), F.col("_at") == F.col("_block"), "inner")
            .filter(hit).select(*[F.col(f"`{c}`") for c in df.columns]))


def lookup_join(facts: DataFrame, dim: DataFrame, left_on: str, right_on: str,
                how: str = "left", drop_right_key: bool = True,
                max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                reduce_dim: Callable[[DataFrame], DataFrame] | None = None,
                strategy: str | None = None) -> DataFrame:
    """Left or inner equi join of a fact table to a dimension.

    ``reduce_dim`` (such as a dedup by ``right_on``) is applied to the dimension
    after its rows without a fact are gone, so it shuffles the rest only; it must
    work key by key. By ``strategy``, or by measured sizes where that is None:

    * ``stream``, facts within the broadcast bound (a lender summary against a
      national registry): the dimension is filtered in place by the broadcast
      fact keys and, without ``reduce_dim``, streamed against the broadcast facts;
    * ``broadcast``, dimension within the bound: it is broadcast;
    * ``bloom``, both larger: the dimension's rows pass a Bloom filter of the fact
      keys before they are shuffled, then an inner join that Spark/AQE may split
      on both sides.

    In the first and the last, the facts of a left join that have no match come
    from an anti join with the dimension's DISTINCT keys (combined in the tasks),
    so a dimension key holding a third of all rows is never one task's load.
    ``facts`` should be a scan or a written table: it is read several times.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    if left_on == right_on:
        named, reduce_named = right_on, reduce_dim or (lambda d: d)
        dim, right_on, drop_right_key = dim.withColumnRenamed(named, "_rkey"), "_rkey", True

        def reduce_dim(d: DataFrame) -> DataFrame:
            return reduce_named(d.withColumnRenamed("_rkey", named)).withColumnRenamed(named, "_rkey")
    reduce_dim = reduce_dim or (lambda d: d)
    lk, rk = f"`{left_on}`", f"`{right_on}`"
    size = None
    if strategy in (None, "bloom"):
        size = measured(facts)
    if strategy is None:
        strategy = ("stream" if fits(size, max_broadcast_rows) else
                    "broadcast" if fits(measured(dim), max_broadcast_rows) else "bloom")

    def columns(d: DataFrame) -> list[Column]:  # facts first, as facts.join(dim)
        return [F.col(f"_f.`{c}`") for c in facts.columns] + [
            F.col(f"_d.`{c}`") for c in d.columns if not (drop_right_key and c == right_on)]

    if strategy == "broadcast":
        d = reduce_dim(dim)
        return facts.alias("_f").join(F.broadcast(d).alias("_d"), F.col(f"_f.{lk}") == F.col(f"_d.{rk}"),
                                      how).select(*columns(d))
    if strategy == "stream":
        keys = F.broadcast(facts.select(F.col(lk).alias("_k")).distinct())
        dim, small = dim.join(keys, dim[rk] == F.col("_k"), "left_semi"), F.broadcast(facts.alias("_f"))
    elif strategy == "bloom":
        bloom = bloom_filter(facts, left_on, size.rows)
        dim, small = bloom_keep(dim, right_on, bloom) if bloom else dim, facts.alias("_f")
    else:
        raise ValueError(strategy)
    d = reduce_dim(dim)
    matched = d.alias("_d").join(small, F.col(f"_f.{lk}") == F.col(f"_d.{rk}"), "inner").select(*columns(d))
    if how == "inner":
        return matched
    dim_keys = dim.select(F.col(rk).alias("_k")).distinct()
    unmatched = facts.join(dim_keys, facts[lk] == F.col("_k"), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def semi_filter(dim: DataFrame, key: str, facts: DataFrame, fact_key: str) -> DataFrame:
    """Keep only dimension rows whose key occurs in the facts (before dedup)."""
    keys = facts.select(F.col(f"`{fact_key}`").alias("_k")).distinct()
    return dim.join(keys, dim[f"`{key}`"] == keys["_k"], "left_semi")


def dedup_first_name(dim: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key, keeping the first name in sort order (NULLs last).

    ``min`` skips NULL, so a key with only NULL names keeps NULL. Partial
    aggregation makes a key with very many rows harmless.
    """
    return dim.groupBy(f"`{key}`").agg(F.min(f"`{name}`").alias(name))


def anti(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``left`` without a match."""
    return left.join(right, on, "left_anti")


def semi(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``left`` with a match."""
    return left.join(right, on, "left_semi")
