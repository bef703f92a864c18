"""The row before each row of a key, without one task per key.

A window partitioned by key puts a whole key into one task. Keys that hold very many rows are therefore cut into slices of
equal row counts: their rows are dealt by range of (key, order), sorted inside each range and cut by their place there. Ranges are
as wide as a task sorts without trouble, whatever the width of a slice, so short slices make no more tasks or files; a range that came out
too large has all ranges made narrower. The window looks back inside each
slice, and the end rows of the slices of a key, found by an aggregate, are compared with those of the next slice. Cuts go by rows and not by
time, so bursts, far-off times and a key with a single time are cut like any other. Rows alike in everything stand once, with their number.
"""

from pyspark.sql import DataFrame, functions as F

from traceops.session import scratch_table

# rows of a key that one task sorts without trouble
SLICE_ROWS = 1_000_000
# rows of a range where slices are shorter
RANGE_ROWS = 200_000
# rows of a task that monotonically_increasing_id numbers
_PLACES = 1 << 33
# rows made at once from one that stands for many
_COPIES = 100_000


def _large_keys(rows: DataFrame, key: str, slice_rows: int) -> tuple[DataFrame, int]:
    """Keys with more than `slice_rows` rows as `_key`, and the rows of all of them.

    There is one for each `slice_rows` rows of the table at most, whatever the table is like.
    """
    counts = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).filter(F.col("_n") > slice_rows)
    keys = scratch_table(counts, "large-keys")
    return keys.drop("_n"), keys.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]


def _sliced(rows: DataFrame, key: str, slice_rows: int, total: int) -> DataFrame:
    """The different rows with `_copies`, their number, and `_slice`, rising with the columns after `key`.

    No slice has more than `slice_rows` rows, and no range more than twice its due.
    """
    once = rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))
    width = max(slice_rows, RANGE_ROWS)
    ranges = max(-(-total // width), 1)
    while True:
        # the number of a row is its place in the range plus _PLACES for each range before
        dealt = (once.repartitionByRange(ranges, *rows.columns).sortWithinPartitions(*rows.columns)
                 .withColumn("_place", F.monotonically_increasing_id()))
        cut = f"_place - _place % {_PLACES} + _place % {_PLACES} div {slice_rows}"
        sliced = scratch_table(dealt.withColumn("_slice", F.expr(cut)), "slices")
        most = sliced.agg(F.max(F.expr(f"_place % {_PLACES} + 1"))).first()[0] or 0
        if most <= 2 * width:
            return sliced.drop("_place")
        ranges *= 2


def followed_by(df: DataFrame, key: str, order: list[str], opens, closes, carry: list[str], slice_rows=SLICE_ROWS) -> DataFrame:
    """Rows where `closes` holds and `opens` holds on the row directly before in the key.

    `order` is the time and what breaks ties; rows alike in it are ordered by `carry`. The columns in `order` and
    `carry` come out for the closing row, and as struct `before` for the opening one. `slice_rows=None` trusts all keys to be
    small and saves the pass that counts them. Where a key is larger, its rows are written below the scratch folder on the way.
    """
    names = list(dict.fromkeys([*order, *carry]))
    quoted = [f"`{c}`" for c in names]
    rows = df.select(key, *names, opens.alias("_opens"), closes.alias("_closes"))
    by = ", ".join([*quoted, "_opens", "_closes"])

    def inside(frame, group):
        # the row before as plain columns: cheaper in a window than a struct
        window = f"(PARTITION BY {group} ORDER BY {by})"
        look_back = [f"lag(`{c}`) OVER {window} AS `_before_{c}`" for c in ["_opens", *names]]
        before = ", ".join(f"`_before_{c}` AS `{c}`" for c in names)
        return (frame.selectExpr("*", *look_back).filter("_closes AND _before__opens")
                .selectExpr(f"`{key}`", *quoted, f"struct({before}) AS before"))

    if slice_rows is None:
        return inside(rows, f"`{key}`")
    keys, total = _large_keys(rows, key, slice_rows)
    if not total:
        return inside(rows, f"`{key}`")

    # the list of keys is as long as the table is large: the join is Spark's choice by its real size
    large = rows[key].eqNullSafe(keys["_key"])
    small = inside(rows.join(keys, large, "left_anti"), f"`{key}`")
    sliced = _sliced(rows.join(keys, large, "left_semi"), key, slice_rows, total)
    found = inside(sliced, f"`{key}`, _slice")
    # across the cuts: the first row of a slice against the last one of the slice before
    end = f"struct({by})"
    ends = sliced.groupBy(key, "_slice").agg(F.expr(f"min({end}) AS first"), F.expr(f"max({end}) AS last"))
    before = ", ".join(f"last.{c}" for c in quoted)
    across = (ends.selectExpr(f"`{key}`", "first", f"lag(last) OVER (PARTITION BY `{key}` ORDER BY _slice) AS last")
              .filter("first._closes AND last._opens")
              .selectExpr(f"`{key}`", *(f"first.{c}" for c in quoted), f"struct({before}) AS before"))
    # a row that stands for several alike is before itself, all but once
    among = (sliced.filter("_opens AND _closes AND _copies > 1")
             .selectExpr("*", f"explode(sequence(0L, (_copies - 2) div {_COPIES})) AS _block")
             .selectExpr("*", f"explode(sequence(1L, least({_COPIES}, _copies - 1 - _block * {_COPIES}))) AS _copy")
             .selectExpr(f"`{key}`", *quoted, f"struct({', '.join(quoted)}) AS before"))
    return small.unionByName(found).unionByName(across).unionByName(among)


def trailing_rate(df: DataFrame, metric: str, ts: str, value: str, span: int,
                  slice_spans=24) -> DataFrame:
    """Change per time unit over the trailing `span`: (last - first) / (t_last - t_first).

    Expects one row per metric and `ts`; gives `(metric, ts, value, rate)`, rate null where
    a row is alone in its span. A metric is cut into slices of `slice_spans` spans; the last
    span of a slice is also handed to the next one, so few metrics still use many tasks.
    """
    width = span * slice_spans
    own = f"(`{ts}` - pmod(`{ts}`, {width})) div {width}"
    late = f"pmod(`{ts}`, {width}) >= {width - span}"
    trailing = f"(PARTITION BY `{metric}`, _slice ORDER BY `{ts}` RANGE BETWEEN {span} PRECEDING AND CURRENT ROW)"
    change = f"(`{value}` - first(`{value}`) OVER {trailing})"
    elapsed = f"nullif(`{ts}` - first(`{ts}`) OVER {trailing}, 0)"
    columns = [f"`{c}`" for c in (metric, ts, value)]
    return (df.selectExpr(*columns, f"{own} AS _own")
            .selectExpr("*", f"explode(IF({late}, array(_own, _own + 1), array(_own))) AS _slice")
            .selectExpr("*", f"{change} / {elapsed} AS rate")
            .filter("_slice = _own").selectExpr(*columns, "rate"))
