"""Window functions that stay distributed without a partition key, or with a very hot one.

A plain ``Window.orderBy`` moves every row to one task, and ``Window.partitionBy`` moves a hot key
to one task. Here rows are cut into buckets by ranges of the whole sort key (partition columns,
ordering, tie-break). Each bucket evaluates the functions locally, and the state it inherits from
the buckets before or after it is added from a small carry table.

Only keys that occur in a bucket bound can continue in another bucket, so the carry table has at
most two rows per bucket, whatever the data size; that is the bound behind its broadcast.

The tie-break must make the sort key unique, otherwise equal rows share one bucket.
"""

from __future__ import annotations

import base64
import datetime
import decimal
import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BUCKET = 1_000_000
MIN_BUCKETS = 8
MAX_BUCKETS = 16_384
SAMPLES_PER_BUCKET = 24

_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_BUCKET = "_bucket"
_SORT = "_sort"


@dataclass(frozen=True)
class Call:
    """One window function: what to compute and on which column."""

    kind: str
    column: str | None = None
    arg: int | None = None


def row_number() -> Call:
    return Call("row_number")


def rank() -> Call:
    return Call("rank")


def dense_rank() -> Call:
    return Call("dense_rank")


def ntile(n: int) -> Call:
    return Call("ntile", arg=n)


def running_sum(column: str) -> Call:
    """Cumulative sum up to and including the row; the column should be an exact type."""
    return Call("running_sum", column)


def lag(column: str) -> Call:
    return Call("lag", column)


def lead(column: str) -> Call:
    return Call("lead", column)


def carry_forward(column: str) -> Call:
    """Last non-null value up to and including the row."""
    return Call("carry_forward", column)


@dataclass(frozen=True)
class _Layout:
    """The bucketed frame and the names of its key columns."""

    df: DataFrame
    parts: list[str]
    orders: list[str]
    ties: list[str]
    bounds: list = field(repr=False)


def ordered_window(
    df: DataFrame,
    calls: dict[str, Call],
    *,
    order_by: list[tuple[str, str]],
    tiebreak: list[str],
    partition_by: tuple[str, ...] | list[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Add the columns named in ``calls`` to ``df``.

    ``order_by`` lists ``(column, "asc" | "desc")``; ``desc`` takes numbers, booleans, dates, timestamps with or without zone,
    text and binary. ``df`` is read several times, so pass a table or a materialised frame.
    """
    layout = _bucketed(df, list(partition_by), order_by, tiebreak, buckets)
    local = _local(layout, calls)
    carry = F.broadcast(_carry(layout, calls))  # at most two rows per bucket
    matched = [local[_BUCKET] == carry["_cb"]] + [
        local[p].eqNullSafe(carry[f"_cp_{p}"]) for p in layout.parts
    ]
    joined = local.join(carry, reduce(Column.__and__, matched), "left")
    results = [_combine(layout, name, call).alias(name) for name, call in calls.items()]
    return joined.select(*df.columns, *results)


# --- bucketing -----------------------------------------------------------------------------


_HEX, _COMPLEMENT, _AFTER_HEX = "0123456789ABCDEF", "FEDCBA9876543210", "G"


def _ascending(col: str, direction: str, dtype: T.DataType) -> dict[str, Column]:
    """Columns that sort ascending the way ``col`` sorts in ``direction``: nulls first, or last when descending.

    Whole numbers are complemented bit by bit, as the least of them has no negative. Text and binary are complemented digit by
    digit in hexadecimal and end in a letter behind all digits, so a text comes after those it is the beginning of.
    """
    c = F.col(col)
    if isinstance(dtype, T.TimestampType):
        number = F.unix_micros(c)
    elif direction == "asc":
        return {col: c}
    elif isinstance(dtype, T.TimestampNTZType):
        # Counted from a time without zone, so no clock change comes in between.
        number = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    elif isinstance(dtype, T.DateType):
        number = F.unix_date(c)
    else:
        number = c
    if direction == "asc":
        return {f"_o_{col}": number}
    last = {f"_n_{col}": c.isNull()}
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType, T.IntegralType)):
        return last | {f"_o_{col}": F.bitwise_not(number)}
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        # NaN is the greatest number. Zero has two signs that count as one.
        zero = F.lit(0).cast(dtype)
        plain = F.when(F.isnan(c) | (c == zero), zero).otherwise(-c)
        return last | {f"_g_{col}": ~F.isnan(c), f"_o_{col}": F.when(c.isNotNull(), plain)}
    if isinstance(dtype, T.DecimalType):
        return last | {f"_o_{col}": -c}
    if isinstance(dtype, T.BooleanType):
        return last | {f"_o_{col}": ~c}
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return last | {f"_o_{col}": F.concat(F.translate(F.hex(c), _HEX, _COMPLEMENT), F.lit(_AFTER_HEX))}
    raise TypeError(f"cannot sort {col} ({dtype.simpleString()}) descending")


def _bucketed(df, partition_by, order_by, tiebreak, buckets) -> _Layout:
    types = {f.name: f.dataType for f in df.schema}
    orders = {n: k for c, d in order_by for n, k in _ascending(c, d, types[c]).items()}
    ties = [t for t in tiebreak if t not in orders and t not in partition_by]
    keyed = df.withColumns({n: k for n, k in orders.items() if n not in df.columns})
    names = [*partition_by, *orders, *ties]
    dtype = T.StructType([T.StructField(n, keyed.schema[n].dataType) for n in names])
    keyed = keyed.withColumn(_SORT, F.struct(*names).cast(dtype))
    bounds = _bounds(keyed.select(_SORT), buckets)
    return _Layout(_with_bucket(keyed, bounds, dtype), partition_by, list(orders), ties, bounds)


def _bounds(keys: DataFrame, buckets: int | None) -> list:
    """Sort keys that cut the frame into about equal buckets, from a sample of bounded size.

    The sample is sorted in one task: a range sort would scan the input once more for its own bounds.
    """
    rows = keys.count()
    if buckets is None:
        buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, rows // ROWS_PER_BUCKET + 1))
    wanted = buckets * SAMPLES_PER_BUCKET
    sampled = keys if rows <= wanted else keys.sample(wanted / rows, seed=17)
    ordered = [r[_SORT] for r in sampled.repartition(1).sortWithinPartitions(_SORT).collect()]
    cuts = [ordered[len(ordered) * i // buckets] for i in range(1, buckets)] if ordered else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def _constant(bounds: list, dtype: T.StructType) -> Column:
    """Sort keys as one constant array, parsed once per plan."""
    names = [f.name for f in dtype]
    rows = json.dumps([b and dict(zip(names, map(_json_value, b))) for b in bounds])
    return F.from_json(F.lit(rows), T.ArrayType(dtype), {"timestampNTZFormat": _NTZ})


def _json_value(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    if isinstance(value, (datetime.date, decimal.Decimal)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return base64.b64encode(value).decode()
    return value


def _with_bucket(df: DataFrame, bounds: list, dtype: T.StructType) -> DataFrame:
    """Add the number of bounds not above the sort key, by bisection inside generated code.

    The bounds form a complete binary tree. Each level is one projection that goes from a node to
    its left or right child, so a row costs log2(buckets) comparisons and the plan grows by as many
    small expressions. Missing bounds at the end are NULL and lead to the left.
    """
    df = df.withColumn(_BUCKET, F.lit(0))
    depth = len(bounds).bit_length()
    size = 1 << depth
    for level in range(depth):
        half = size >> (level + 1)
        nodes = [bounds[p] if p < len(bounds) else None for p in range(half - 1, size - 1, 2 * half)]
        right = F.when(F.col(_SORT) >= _constant(nodes, dtype)[F.col(_BUCKET)], 1).otherwise(0)
        df = df.withColumn(_BUCKET, F.col(_BUCKET) * 2 + right)
    return df


# --- inside a bucket -----------------------------------------------------------------------


def _local(layout: _Layout, calls: dict[str, Call]) -> DataFrame:
    group = Window.partitionBy(_BUCKET, *layout.parts)
    w = group.orderBy(*layout.orders, *layout.ties)
    by_value = group.orderBy(*layout.orders)
    to_here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local: dict[str, Column] = {}
    for name, call in calls.items():
        if call.kind in ("row_number", "ntile"):
            local["_l_rn"] = F.row_number().over(w).cast("bigint")
        if call.kind == "ntile":
            local["_l_n"] = F.count(F.lit(1)).over(group)
        elif call.kind == "rank":
            local["_l_rank"] = F.rank().over(by_value).cast("bigint")
        elif call.kind == "dense_rank":
            local["_l_dense"] = F.dense_rank().over(by_value).cast("bigint")
        elif call.kind == "running_sum":
            local[f"_l_{name}"] = F.sum(call.column).over(to_here)
        elif call.kind == "carry_forward":
            local[f"_l_{name}"] = F.last(call.column, ignorenulls=True).over(to_here)
        elif call.kind in ("lag", "lead"):
            # Wrapped, so a NULL neighbour differs from having no neighbour in this bucket.
            function = F.lag if call.kind == "lag" else F.lead
            local[f"_l_{name}"] = function(F.struct(F.col(call.column).alias("v"))).over(w)
    return layout.df.withColumns(local)


# --- across buckets ------------------------------------------------------------------------


def _carry(layout: _Layout, calls: dict[str, Call]) -> DataFrame:
    spark = layout.df.sparkSession
    frame = layout.df
    if layout.parts:
        fields = [T.StructField(p, frame.schema[p].dataType) for p in layout.parts]
        keys = {tuple(b[: len(fields)]) for b in layout.bounds}
        spanning = spark.createDataFrame(list(keys), T.StructType(fields))
        same = [frame[p].eqNullSafe(spanning[p]) for p in layout.parts]
        # At most one key per bound.
        frame = frame.join(F.broadcast(spanning), reduce(Column.__and__, same), "left_semi")

    kinds = {c.kind for c in calls.values()}
    cells = [_BUCKET, *layout.parts]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for name, call in calls.items():
        if call.kind == "running_sum":
            aggs.append(F.sum(call.column).alias(f"_s_{name}"))
        elif call.kind == "carry_forward":
            present = F.col(call.column).isNotNull()
            aggs.append(F.max_by(call.column, F.when(present, F.col(_SORT))).alias(f"_s_{name}"))
        elif call.kind in ("lag", "lead"):
            edge = F.max_by if call.kind == "lag" else F.min_by
            aggs.append(edge(F.struct(F.col(call.column).alias("v")), F.col(_SORT)).alias(f"_s_{name}"))
    summary = frame.groupBy(*cells).agg(*aggs)

    group = Window.partitionBy(*(layout.parts or [F.lit(0)]))
    along = group.orderBy(_BUCKET)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = {"_c_rows": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_c_total": F.sum("_n").over(group)}
    for name, call in calls.items():
        state = f"_s_{name}"
        if call.kind == "running_sum":
            carried[f"_c_{name}"] = F.sum(state).over(before)
        elif call.kind == "carry_forward":
            carried[f"_c_{name}"] = F.last(state, ignorenulls=True).over(before)
        elif call.kind == "lag":
            carried[f"_c_{name}"] = F.lag(state).over(along)
        elif call.kind == "lead":
            carried[f"_c_{name}"] = F.lead(state).over(along)
    summary = summary.withColumns(carried)

    if kinds & {"rank", "dense_rank"}:
        runs = _value_runs(frame, layout)
        same_cell = [summary[_BUCKET] == runs["_rb"]] + [summary[p].eqNullSafe(runs[f"_rp_{p}"]) for p in layout.parts]
        summary = _rank_carry(summary.join(runs, reduce(Column.__and__, same_cell)), layout, along)
    renamed = [F.col(_BUCKET).alias("_cb"), *[F.col(p).alias(f"_cp_{p}") for p in layout.parts]]
    return summary.select(*renamed, *[c for c in summary.columns if c.startswith("_c_")])


def _value_runs(frame: DataFrame, layout: _Layout) -> DataFrame:
    """Per bucket: distinct ordering values, the first and last one, rows below the last one."""
    cells = [_BUCKET, *layout.parts]
    values = frame.groupBy(*cells, *layout.orders).agg(F.count(F.lit(1)).alias("_rows"))
    value = F.struct(*layout.orders)
    named = [F.col(_BUCKET).alias("_rb"), *[F.col(p).alias(f"_rp_{p}") for p in layout.parts]]
    return values.groupBy(*named).agg(
        F.count(F.lit(1)).alias("_d"),
        F.min(value).alias("_first"),
        F.max(value).alias("_last"),
        (F.sum("_rows") - F.max_by("_rows", value)).alias("_below_last"),
    )


def _rank_carry(summary: DataFrame, layout: _Layout, along) -> DataFrame:
    """Rank and dense rank a bucket inherits when its first value continues from the bucket before."""
    tie = F.coalesce(F.lag("_last").over(along) == F.col("_first"), F.lit(False))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    run = Window.partitionBy(*layout.parts, "_last").orderBy(_BUCKET)
    runs = summary.withColumns({
        "_run_rank": F.first(F.col("_c_rows") + F.col("_below_last")).over(run) + 1,
        "_tie": tie.cast("int"),
    })
    new_values = F.sum(F.col("_d") - F.col("_tie")).over(before)
    return runs.withColumns({
        "_c_first": F.when(F.col("_tie") == 1, F.col("_first")),
        "_c_rank": F.lag("_run_rank").over(along),
        "_c_dense": F.coalesce(new_values, F.lit(0)) - F.col("_tie"),
    })


def _combine(layout: _Layout, name: str, call: Call) -> Column:
    rows = F.coalesce(F.col("_c_rows"), F.lit(0))
    if call.kind == "row_number":
        return F.col("_l_rn") + rows
    if call.kind == "rank":
        continued = F.col("_c_first").isNotNull() & (F.struct(*layout.orders) == F.col("_c_first"))
        return F.when(continued, F.col("_c_rank")).otherwise(F.col("_l_rank") + rows)
    if call.kind == "dense_rank":
        return F.col("_l_dense") + F.coalesce(F.col("_c_dense"), F.lit(0))
    if call.kind == "ntile":
        return _tile(F.col("_l_rn") + rows, F.coalesce(F.col("_c_total"), F.col("_l_n")), call.arg)
    own, inherited = F.col(f"_l_{name}"), F.col(f"_c_{name}")
    if call.kind == "running_sum":
        return F.when(inherited.isNull(), own).when(own.isNull(), inherited).otherwise(own + inherited)
    if call.kind == "carry_forward":
        return F.coalesce(own, inherited)
    return F.coalesce(own, inherited)["v"]


def _tile(number: Column, total: Column, n: int) -> Column:
    """Tile of a row number: the first ``total % n`` tiles hold one row more."""
    size, longer = F.floor(total / n), total % n
    in_longer = longer * (size + 1)
    first = F.floor((number - 1) / (size + 1)) + 1
    rest = longer + F.floor((number - in_longer - 1) / F.greatest(size, F.lit(1))) + 1
    return F.when(number <= in_longer, first).otherwise(rest).cast("bigint")
