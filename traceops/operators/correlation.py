"""Correlation over the rows of a many-to-many join, without making those rows.

A key with n rows left and m rows right stands for n*m joined rows. Over those, every left
value meets every right value, so the count, sum and sum of squares of each side per key say
all that Pearson needs. Both sides shrink to one row per key before anything is joined, which
also takes care of keys with very many rows.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from traceops.session import scratch_table


def _per_key(df: DataFrame, keys: list[str], cols: list[str], side: str, center: bool) -> DataFrame:
    rows = df.select(*keys, *(F.col(c).cast("double").alias(c) for c in cols)).dropna()
    if center:
        # any shift gives the same correlation; one near the data keeps digits
        means = rows.agg(*(F.avg(c).alias(c) for c in cols))
        rows = rows.select(*keys, *((F.col(c) - means.select(c).scalar()).alias(c) for c in cols))
    sums = [f"double(count(*)) AS {side}n"]
    for c in cols:
        sums += [f"sum(`{c}`) AS `{side}sum_{c}`", f"sum(`{c}` * `{c}`) AS `{side}squares_{c}`",
                 f"min(`{c}`) AS `{side}min_{c}`", f"max(`{c}`) AS `{side}max_{c}`"]
    return rows.groupBy(*keys).agg(*(F.expr(s) for s in sums))


def join_correlation(left: DataFrame, right: DataFrame, keys: list[str],
                     pairs: dict[str, tuple[str, str]], center=True) -> DataFrame:
    """One row: the number of joined rows as `pair_count` (decimal), and per label the correlation.

    `pairs` maps a label to (left column, right column). Rows with a null in a key or in one
    of the columns are left out, as a plain join after dropping them would. A constant side
    or an empty join gives null. `center=False` saves a pass where values are near 0 anyway.
    """
    xs, ys = (list(dict.fromkeys(p[side] for p in pairs.values())) for side in (0, 1))
    joined = _per_key(left, keys, xs, "l", center).join(_per_key(right, keys, ys, "r", center), keys)
    # the number of pairs as whole number: the product of two row counts may be beyond a long
    sums = ["sum(ln * rn) AS w", "sum(CAST(ln AS DECIMAL(19, 0)) * CAST(rn AS DECIMAL(19, 0))) AS n"]
    result = ["coalesce(n, CAST(0 AS DECIMAL(38, 0))) AS pair_count"]
    for i, (label, (a, b)) in enumerate(pairs.items()):
        sums += [f"sum(rn * `lsum_{a}`) AS x{i}", f"sum(rn * `lsquares_{a}`) AS xx{i}",
                 f"sum(ln * `rsum_{b}`) AS y{i}", f"sum(ln * `rsquares_{b}`) AS yy{i}",
                 f"sum(`lsum_{a}` * `rsum_{b}`) AS xy{i}",
                 # exact, as rounding can leave a trace of spread on a constant side
                 f"min(`lmin_{a}`) < max(`lmax_{a}`) AND min(`rmin_{b}`) < max(`rmax_{b}`) AS varies{i}"]
        spread = " * ".join(f"sqrt(greatest({v}{v}{i} / w - pow({v}{i} / w, 2), 0D))" for v in "xy")
        result.append(f"IF(varies{i}, (xy{i} / w - x{i} / w * y{i} / w) / nullif({spread}, 0D), NULL) AS `{label}`")
    return joined.agg(*(F.expr(s) for s in sums)).selectExpr(*result)


def _digest(cols: list[str]) -> Column:
    # a null is a value of its own, and no value runs into the next one
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


# first signs of a digest: 4096 groups, few enough for one task and enough to spread a hot key
_GROUP_SIGNS = 3


def _whole(n) -> str:
    return f"CAST('{n}' AS DECIMAL(38, 0))"


def _over(a: str, b: str) -> str:
    """The whole part of a / b for decimals: `div` gives a long, which pair numbers may not fit into."""
    return f"CAST((({a}) - ({a}) % ({b})) / ({b}) AS DECIMAL(38, 0))"


def _chosen_pairs(sizes: DataFrame, keys: list[str], fraction: float, n: int, seed: int) -> DataFrame | None:
    """`(keys, _number, _left, _right)`: pair numbers, and the ranks of their rows within the key on both sides.

    All pairs are numbered: key after key, and within a key by the rank of the left row, then of the right one. The numbers are
    cut into as many equal stretches as pairs are wanted, and a hash of the stretch picks one number of it.
    """
    pairs = sizes.withColumn("_p", F.expr("CAST(_l AS DECIMAL(19, 0)) * CAST(_r AS DECIMAL(19, 0))")).withColumn(
        "_group", F.substring(_digest(keys), 1, _GROUP_SIGNS))
    groups = pairs.groupBy("_group").agg(F.expr("CAST(sum(_p) AS DECIMAL(38, 0)) AS _pairs"))
    total = groups.agg(F.sum("_pairs")).first()[0]
    if not total:
        return None
    total = int(total)
    wanted = min(n, math.ceil(float(total) * fraction))
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    zero, all_pairs, some = _whole(0), _whole(total), _whole(wanted)
    bases = groups.selectExpr("_group", f"CAST(coalesce(sum(_pairs) OVER (ORDER BY _group {before}), {zero}) AS DECIMAL(38, 0)) AS _base")
    order = ", ".join(f"`{c}`" for c in keys)
    first = f"CAST(_base + coalesce(sum(_p) OVER (PARTITION BY _group ORDER BY {order} {before}), {zero}) AS DECIMAL(38, 0))"
    placed = pairs.join(bases, "_group").selectExpr(*(f"`{c}`" for c in keys), "_r", "_p", f"{first} AS _first")
    # stretches that the numbers of a key may lie in: few for most keys, all for a key with most pairs
    reached = placed.selectExpr("*", f"explode(sequence(CAST({_over(f'_first * {some}', all_pairs)} AS BIGINT), "
                                     f"CAST({_over(f'(_first + _p) * {some}', all_pairs)} AS BIGINT))) AS _j").filter(f"_j < {wanted}")
    low, high = (_over(f"CAST(_j + {i} AS DECIMAL(38, 0)) * {all_pairs}", some) for i in (0, 1))
    share = f"CAST(conv(substring(md5(CAST(concat('{seed}:', _j) AS BINARY)), 1, 8), 16, 10) AS DECIMAL(10, 0))"
    numbered = (reached.selectExpr("*", f"{low} AS _low", f"{high} AS _high", f"{share} AS _share")
                .withColumn("_number", F.expr(f"CAST(_low + {_over('CAST(_share * (_high - _low) AS DECIMAL(38, 0))', _whole(2 ** 32))} AS DECIMAL(38, 0))"))
                .filter("_number >= _first AND _number < _first + _p")
                .withColumn("_own", F.expr("CAST(_number - _first AS DECIMAL(38, 0))")))
    rank = _over("_own", "CAST(_r AS DECIMAL(38, 0))")
    return numbered.selectExpr(*(f"`{c}`" for c in keys), "_number", f"CAST({rank} AS BIGINT) AS _left",
                               f"CAST(_own % CAST(_r AS DECIMAL(38, 0)) AS BIGINT) AS _right")


def _rows_of_rank(rows: DataFrame, keys: list[str], order: list[str], chosen: DataFrame, rank: str, name: str) -> DataFrame:
    """`_number` and, as struct `name`, the row of the chosen rank within its key, by the digest of `order`, then all columns.

    A key is spread over groups of digests; the groups before a row and the rows before it in its group make its rank. Rows
    alike in all columns stand once, with their number.
    """
    columns = [f"`{c}`" for c in rows.columns]
    key_columns = [f"`{c}`" for c in keys]
    once = (rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies")).withColumn("_digest", _digest(order))
            .withColumn("_group", F.substring("_digest", 1, _GROUP_SIGNS)))
    sizes = once.groupBy(*keys, "_group").agg(F.sum("_copies").alias("_size"))
    starts = sizes.selectExpr("*", f"coalesce(sum(_size) OVER (PARTITION BY {', '.join(key_columns)} ORDER BY _group "
                                   "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _start")
    grouped = (chosen.join(starts, keys).filter(f"{rank} >= _start AND {rank} < _start + _size")
               .selectExpr(*key_columns, "_group", "_number", f"{rank} - _start AS _place"))
    near = once.join(grouped.select(*keys, "_group").distinct(), [*keys, "_group"], "left_semi")
    upto = near.selectExpr(*columns, "_group", "_copies", f"sum(_copies) OVER (PARTITION BY {', '.join(key_columns)}, _group "
                           f"ORDER BY _digest, {', '.join(columns)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _upto")
    rest = [c for c in rows.columns if c not in keys]
    return (grouped.join(upto, [*keys, "_group"]).filter("_place < _upto AND _place >= _upto - _copies")
            .select("_number", *([*keys] if name == "_l" else []), F.struct(*(F.col(f"`{c}`") for c in rest)).alias(name)))


def sample_join(left: DataFrame, right: DataFrame, keys: list[str], fraction=0.01, seed=42,
                n=10_000, left_order: list[str] | None = None, right_order: list[str] | None = None) -> DataFrame:
    """Rows of the inner join: `fraction` of them rounded up, or `n` where that is more, exactly so many and always the same.

    Every joined row is taken with about the same probability. From the row counts of the keys the number of joined rows
    is known; pair numbers are chosen by hash and decoded to the ranks of a left and a right row within their key, and only
    those rows are looked up, so neither the join nor all rows of one key come together. Ranks go by a digest of the `order` columns
    (all by default). The chosen numbers, `n` at most, are written below the scratch folder on the way. Null keys join nothing.
    """
    left, right = (df.dropna(subset=keys) for df in (left, right))
    sizes = (left.groupBy(*keys).agg(F.count("*").alias("_l"))
             .join(right.groupBy(*keys).agg(F.count("*").alias("_r")), keys))
    chosen = _chosen_pairs(sizes, keys, fraction, n, seed)
    if chosen is None:
        return left.join(right, keys).limit(0)
    chosen = scratch_table(chosen, "pair-numbers")
    one = _rows_of_rank(left, keys, left_order or left.columns, chosen, "_left", "_l")
    two = _rows_of_rank(right, keys, right_order or right.columns, chosen, "_right", "_r")
    rest = lambda df, name: [F.col(f"{name}.`{c}`").alias(c) for c in df.columns if c not in keys]
    return one.join(two, "_number").select(*keys, *rest(left, "_l"), *rest(right, "_r"))


def plot_sample(df: DataFrame, key: list[str], fraction=0.01, n=10_000) -> DataFrame:
    """Up to `n` rows for a plot: those whose `key` has an md5 below `fraction`, least first.

    The hash spreads over the whole table whatever its order, and the same table always gives
    the same rows. `key` should tell rows apart, as rows alike in it come and go together.
    """
    rows = df.withColumn("_digest", _digest(key))
    if fraction < 1:
        rows = rows.filter(F.col("_digest") < f"{int(fraction * 16 ** 12):012x}")
    return rows.orderBy("_digest", *key).limit(n).drop("_digest")
