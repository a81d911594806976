"""Anti joins against lists of any size.

A list within the broadcast bound is broadcast.  For a larger one a shuffle
join would move every (wide) row to find the few that are listed.  Instead a
Bloom filter of the list goes to the rows: one aggregation sets the bits of
all keys, and a row whose key cannot be listed never leaves its task.  Only
the rest, the listed rows and a few false positives, meets the list itself in
the exact anti join, so the result does not depend on the filter.

The filter is blocked: a key sets eight bits, two in each of four words of
one block, so a row needs one block only and finds it by an equi-join on the
block's number.  The number of blocks is bounded by the size the caller
allows to be broadcast, whatever the list's size; where that leaves too few
bits a key, the filter would pass too much and the plain join runs.

NULL keys match nothing: they stay, and never take part in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.operators.joins import bytes_at_most

WORDS = 4
#: Bits of the filter for each key, where there is room: about 1 false positive in 1,000 rows.
BITS_PER_KEY = 16
#: With fewer bits a key than this, more than a quarter of the unlisted rows would pass: no filter.
MIN_BITS_PER_KEY = 4
#: A block as broadcast: key, words, and what the hash table adds.
BLOCK_BYTES = 96
#: The filter's size in memory is known, a list's only as compressed files, which can be ten
#: times as large in memory: for each byte of bound the filter may have so many.
IN_MEMORY = 8
_BLOCK = "_block"
_WORDS = [f"_word{i}" for i in range(WORDS)]


def _masks(key: Column) -> list[Column]:
    """The bits of a key in its block's words."""
    h = F.xxhash64(F.lit("bits"), key)
    bit = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(63).cast("int"))
           for i in range(2 * WORDS)]
    return [bit[2 * i].bitwiseOR(bit[2 * i + 1]) for i in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias(_BLOCK)


def blocks_for(keys: int, max_bytes: int) -> int:
    """Blocks of a filter over ``keys`` keys within ``max_bytes``; 0 if it would be of no use."""
    room = max_bytes // BLOCK_BYTES
    bits = 64 * WORDS
    wanted = -(-keys * BITS_PER_KEY // bits)
    least = -(-keys * MIN_BITS_PER_KEY // bits)
    return 0 if room < max(1, least) else max(1, min(wanted, room))


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter's blocks that have a bit: at most ``blocks`` rows, combined on the map side."""
    words = [F.bit_or(m).alias(w) for m, w in zip(_masks(F.col(key)), _WORDS, strict=True)]
    return keys.filter(F.col(key).isNotNull()).groupBy(_block(F.col(key), blocks)).agg(*words)


def probed(rows: DataFrame, key: str, filter_: DataFrame, blocks: int, out: str) -> DataFrame:
    """``rows`` with a flag: False only if the key is surely not in the filter (NULL keys: False)."""
    hit = [F.col(w).bitwiseAND(m) == m for w, m in zip(_WORDS, _masks(F.col(key)), strict=True)]
    may = hit[0] & hit[1] & hit[2] & hit[3] & F.col(key).isNotNull()
    return (rows.withColumn(_BLOCK, _block(F.col(key), blocks)).join(F.broadcast(filter_), _BLOCK, "left")
            .withColumn(out, F.coalesce(may, F.lit(False))).drop(_BLOCK, *_WORDS))


def exclude(rows: DataFrame, lists: dict[str, DataFrame], max_broadcast_bytes: int | None = None,
            max_list_bytes: int | None = None) -> DataFrame:
    """``rows`` whose keys are in none of the lists.

    ``lists`` maps a column of ``rows`` to a one-column table of the same
    column name.  ``max_broadcast_bytes`` bounds what each list broadcasts:
    the list itself if its files pass the size check, else its filter (in
    memory, :data:`IN_MEMORY` times the bound)
    (``max_list_bytes``: another bound for whole lists).  Without it the joins
    are left to the planner.  ``rows`` and the lists should be
    stored tables: a list over the bound is counted for the size of its
    filter, and the branch of the unlisted rows reads ``rows`` apart from the
    branch of the others.  Rows repeat as they do in ``rows``; their order is
    not kept.
    """
    columns = rows.columns
    filters: dict[str, tuple[DataFrame, int]] = {}
    for key, listed in lists.items():
        if max_broadcast_bytes is None:
            rows = rows.join(listed, key, "left_anti")
        elif bytes_at_most(listed, max_broadcast_bytes if max_list_bytes is None else max_list_bytes):
            rows = rows.join(F.broadcast(listed), key, "left_anti")
        elif blocks := blocks_for(listed.count(), IN_MEMORY * max_broadcast_bytes):
            filters[key] = (bloom_filter(listed, key, blocks), blocks)
        else:
            rows = rows.join(listed, key, "left_anti")
    if not filters:
        return rows.select(*columns)
    # All filters are asked in one pass; a row goes to the joins if any of them lets it through.
    flags = {key: f"_may_be_in_{n}" for n, key in enumerate(filters)}
    asked = rows
    for key, (filter_, blocks) in filters.items():
        asked = probed(asked, key, filter_, blocks, flags[key])
    may = reduce(lambda a, b: a | b, [F.col(f) for f in flags.values()])
    checked = asked.filter(may)
    for key in filters:
        # No hint: the list is over the bound.  No distinct either: duplicates do not
        # change an anti join, and plain shuffles let AQE split a hot key.
        checked = checked.join(lists[key], key, "left_anti")
    return asked.filter(~may).select(*columns).unionByName(checked.select(*columns))
