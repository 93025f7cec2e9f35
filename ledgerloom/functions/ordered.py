"""Values carried along an ordered history, safe for a key that holds most of the rows.

A plain window puts every row of one key into one task. Here the few keys that hold a large share of the rows are cut into
chunks along their order. Rows are exchanged once, by (key, chunk); each chunk's last row is taken on that same partitioning,
a small window over these ends gives what each chunk starts from, and the starts are joined back to the rows, which stay where
they are. The row-level window is then partitioned by (key, chunk), so a hot key is spread over as many tasks as it has
chunks, and the result is the same as that of the plain window. Without a hot key it is the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.stages import cut

AUTO = "auto"
_CHUNK, _START, _ROW, _COUNT = "__chunk", "__start", "__row", "__count"

#: Rows sampled to find hot keys, and the pieces that all rows are cut into: a key with more than its share of the sample is cut.
SAMPLE_ROWS, PIECES, LEAST_PIECE = 1 << 16, 256, 64


def default_chunk(df: DataFrame, order: str) -> Column:
    """A day of a time column, or a block of 65,536 of an integer column."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_date(F.col(order).cast("date")).cast("bigint")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.shiftright(F.col(order).cast("bigint"), 16)
    raise ValueError(f"order column {order!r} of type {kind.simpleString()} needs an explicit chunk")


def prefix_chunk(df: DataFrame, order: Sequence[str], exact: int = 1) -> Column:
    """A chunk for an order whose first ``exact`` columns have few values, or one: these as they are, then the next one's chunk.

    It never decreases along the order, and splits a key whose rows agree in the first columns.
    """
    return F.struct(*order[:exact], default_chunk(df, order[exact]).alias("block"))


def sampled_chunk(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, sample_rows: int = SAMPLE_ROWS, pieces: int = PIECES, least: int = LEAST_PIECE
) -> Column | None:
    """A chunk by bounds along the order of hot keys, from a sample of all rows' keys and orders; None if no key is hot.

    The sample is the ``sample_rows`` rows of least hash of key and order: one pruned scan, partial top-k per task; only the sampled
    orders of hot keys come to the driver. A key with more than 1 / ``pieces`` of a full sample gets a bound after every such
    share, whatever its order columns hold: a constant one, texts or times. All other keys stay whole.
    """
    names = [*keys, *order]
    picked = df.select(*names).orderBy(F.xxhash64(*names), *names).limit(sample_rows)
    share = max(least, -(-sample_rows // pieces))
    found = picked.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("found"))
    hot = found.where(F.size("found") > share).orderBy(*keys).collect()
    kinds = {n: df.schema[n].dataType for n in names}
    literal = lambda name, value: F.lit(value).cast(kinds[name])
    at = F.struct(*[F.col(name) for name in order])
    chunk = None
    for row in hot:
        key, bounds = [row[name] for name in keys], [tuple(at) for at in row["found"]][share::share]
        if any(k is None for k in key):
            continue
        # Two steps, so that a row is compared with about twice the root of the number of bounds.
        step = max(1, int(len(bounds) ** 0.5))
        blocks = [bounds[k : k + step] for k in range(0, len(bounds), step)]
        as_struct = lambda bound: F.struct(*[literal(n, v).alias(n) for n, v in zip(order, bound, strict=True)])
        passed = lambda bound: bound <= at
        block = F.size(F.filter(F.array(*[as_struct(b[0]) for b in blocks]), passed))
        inner = F.get(F.array(*[F.array(*map(as_struct, b)) for b in blocks]), block - 1)
        place = F.when(block == 0, 0).otherwise((block - 1) * step + F.size(F.filter(inner, passed)))
        same = F.lit(True)
        for name, value in zip(keys, key, strict=True):
            same = same & (F.col(name) == literal(name, value))
        chunk = F.when(same, place) if chunk is None else chunk.when(same, place)
    return None if chunk is None else chunk.otherwise(0)


def with_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lag: Mapping[str, Column] | None = None,
    last_valid: Mapping[str, Column] | None = None,
    seen: Mapping[str, Column] | None = None,
    position: str | None = None,
    chunk: Column | str | None = AUTO,
) -> DataFrame:
    """Add columns that look back along each key's history.

    ``lag``: value on the previous row. ``last_valid``: last non-null value on any earlier row.
    ``seen``: whether a flag was true on any earlier row. ``position``: 1-based row number.
    ``order`` must be a total order inside a key; rows with a null key have no history and are
    left out. ``chunk`` is a Column that never decreases along ``order``; the default is :func:`sampled_chunk`, which
    takes a sample when the plan is made; ``None`` keeps every history in one chunk. Where histories are cut, both uses of the
    exchanged rows take all columns of ``df``, so that Spark reads and exchanges them once: pass the columns that are used.
    """
    lag, last_valid, seen = dict(lag or {}), dict(last_valid or {}), dict(seen or {})
    keys, order = list(keys), list(order)
    base = df.where(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    if isinstance(chunk, str):
        chunk = sampled_chunk(base, keys, order)
    values = {**lag, **last_valid, **{n: F.coalesce(flag, F.lit(False)) for n, flag in seen.items()}}
    carried = {n: f"__in_{n}" for n in values}
    base = base.withColumns({carried[n]: value for n, value in values.items()})

    parts = keys
    if chunk is not None:
        parts = [*keys, _CHUNK]
        base = base.withColumn(_CHUNK, chunk)
        base = base.repartition(*parts)
        base = base.join(_chunk_starts(base, keys, order, {n: carried[n] for n in lag}, {n: carried[n] for n in last_valid}, {n: carried[n] for n in seen}), parts, "left")

    start = (lambda name: F.col(_START)[name]) if chunk is not None else (lambda name: F.lit(None))
    window = Window.partitionBy(*parts).orderBy(*order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    out: dict[str, Column] = {_ROW: F.row_number().over(window).cast("bigint")} if lag or position else {}
    for name in lag:
        out[f"__lag_{name}"] = F.lag(carried[name]).over(window)
    for name in last_valid:
        out[f"__valid_{name}"] = F.last(carried[name], ignorenulls=True).over(earlier)
    for name in seen:
        out[f"__seen_{name}"] = F.max(carried[name]).over(earlier)
    result = base.select("*", *[value.alias(name) for name, value in out.items()])
    cut = chunk is not None
    final: dict[str, Column] = {}
    for name in lag:
        before = F.col(f"__lag_{name}")
        final[name] = F.when(F.col(_ROW) == 1, start(name)).otherwise(before) if cut else before
    for name in last_valid:
        found = F.col(f"__valid_{name}")
        final[name] = F.coalesce(found, start(name)) if cut else found
    for name in seen:
        found = F.coalesce(f"__seen_{name}", F.lit(False))
        final[name] = found | F.coalesce(start(name), F.lit(False)) if cut else found
    if position:
        final[position] = F.col(_ROW) + F.coalesce(start(_COUNT), F.lit(0)) if cut else F.col(_ROW)
    kept = [c for c in df.columns if c not in final]
    return result.select(*[F.col(f"`{c}`") for c in kept], *[value.alias(name) for name, value in final.items()])


def _chunk_starts(base: DataFrame, keys: list[str], order: list[str], lag: Mapping[str, str], valid: Mapping[str, str], seen: Mapping[str, str]) -> DataFrame:
    """(key, chunk, start) of every chunk that has an earlier one: the values its first row looks back on.

    ``base`` is exchanged by key and chunk already. A chunk's end is its whole last row, so this needs the columns that the rows
    themselves need, and the exchange is one.
    """
    at = F.struct(*[F.col(name) for name in order])
    totals = [F.max_by(F.struct(*[F.col(f"`{c}`") for c in base.columns]), at).alias("end"), F.count(F.lit(1)).alias(_COUNT)]
    for name, column in valid.items():
        totals.append(F.max_by(column, F.when(F.col(column).isNotNull(), at)).alias(name))
    for name, column in seen.items():
        totals.append(F.max(column).alias(name))
    ends = base.groupBy(*keys, _CHUNK).agg(*totals)
    window = Window.partitionBy(*keys).orderBy(_CHUNK)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    starts = [F.sum(_COUNT).over(earlier).alias(_COUNT)]
    for name, column in lag.items():
        starts.append(F.lag(F.col("end")[column]).over(window).alias(name))
    for name in valid:
        starts.append(F.last(name, ignorenulls=True).over(earlier).alias(name))
    for name in seen:
        starts.append(F.max(name).over(earlier).alias(name))
    found = ends.select(*keys, _CHUNK, F.struct(*starts).alias(_START))
    return found.where(F.col(_START)[_COUNT].isNotNull())


def positioned(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's 1-based place in a global order; no task sees more than its range of the order.

    Rows are exchanged by range and sorted there; the numbers of rows per range, one short row for each, give where every range
    begins. The sorted rows are checkpointed, for a range must be the same in both uses. Rows equal in ``order`` get places in
    any order among themselves.
    """
    sort = [o.asc_nulls_first() for o in order]
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__at", F.monotonically_increasing_id())
    ranged = cut(ranged)
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start"))
    joined = ranged.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__start") + place + 1).alias(name))
