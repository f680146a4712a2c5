"""Fill-forward over an ordered key without one task per hot key.

``last(x, ignorenulls) OVER (PARTITION BY key ORDER BY pos)`` puts every row
of a key in one task. When one key holds a large share of the rows that task
holds it all. ``carry_forward`` splits each key into blocks of consecutive
positions and scans in two levels:

1. within a block: a window over ``(key, block)``;
2. across blocks: the last non-null value of each block (a partial
   aggregate, so a hot key is combined map-side) and a window over the
   block summaries of the key, which has ``rows / block_size`` rows.

Several columns are carried in the same pass. The result equals the
one-level window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 4096


def carry_forward_many(
    df: DataFrame,
    key: list[str],
    pos: str,
    specs: list[tuple[str, str, bool]],
    block_size: int = DEFAULT_BLOCK,
) -> DataFrame:
    """For each ``(value, out, inclusive)`` add ``out`` = the last non-null
    ``value`` of the same ``key`` at a position ``<= pos`` (``< pos`` when
    not ``inclusive``). ``pos`` must be integral and unique within a key."""
    blk = "__blk"
    d = df.withColumn(blk, F.floor(F.col(pos) / F.lit(block_size)))
    w_in = Window.partitionBy(*key, blk).orderBy(pos)
    for i, (value, _, inclusive) in enumerate(specs):
        frame = w_in.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        d = d.withColumn(f"__in{i}", F.last(F.col(value), ignorenulls=True).over(frame))

    # one row per (key, block): the last non-null value of each column inside it
    last_in_block = [
        F.max(F.when(F.col(v).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(v).alias("v"))))
        .getField("v")
        .alias(f"__bl{i}")
        for i, (v, _, _) in enumerate(specs)
    ]
    blocks = df.withColumn(blk, F.floor(F.col(pos) / F.lit(block_size))).groupBy(*key, blk).agg(*last_in_block)
    w_blocks = Window.partitionBy(*key).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(
        *key,
        blk,
        *[F.last(F.col(f"__bl{i}"), ignorenulls=True).over(w_blocks).alias(f"__cy{i}") for i in range(len(specs))],
    )
    d = d.join(carry, [*key, blk], "left")
    for i, (_, out, _) in enumerate(specs):
        d = d.withColumn(out, F.coalesce(F.col(f"__in{i}"), F.col(f"__cy{i}")))
    return d.drop(blk, *[f"__in{i}" for i in range(len(specs))], *[f"__cy{i}" for i in range(len(specs))])


def carry_forward(
    df: DataFrame,
    key: list[str],
    pos: str,
    value: str,
    out: str,
    inclusive: bool = True,
    block_size: int = DEFAULT_BLOCK,
) -> DataFrame:
    """One column of ``carry_forward_many``."""
    return carry_forward_many(df, key, pos, [(value, out, inclusive)], block_size)
