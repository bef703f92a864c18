"""One row per key: newest record, counts of hits, peaks; and how two of them relate."""

from pyspark.sql import Column, DataFrame, functions as F

from traceops.functions.buckets import quarter
from traceops.functions.casts import filled, flag
from traceops.functions.stats import pearson


# bits of whole numbers and times, one more being for nulls, which come first; a decimal holds 126
_BITS = {"tinyint": 9, "smallint": 17, "int": 33, "bigint": 65, "date": 33, "timestamp": 65, "timestamp_ntz": 65}
_FIXED = ("boolean", "float", "double", *_BITS)
_LEAST_HASH = 16


def _packed(df: DataFrame, order: list[str], cols: list[str]) -> Column | None:
    """One number that orders rows as `order` does, then by a hash of `cols`; none where it would not fit."""
    types = dict(df.dtypes)
    free = 126 - sum(_BITS.get(types[c], 126) for c in order)
    if free < _LEAST_HASH or any(types[c] not in _FIXED for c in cols):
        return None
    total = "CAST(0 AS DECIMAL(38, 0))"
    for c in order:
        whole = {"date": f"unix_date(`{c}`)", "timestamp": f"unix_micros(`{c}`)", "timestamp_ntz": f"unix_micros(CAST(`{c}` AS TIMESTAMP))"}.get(types[c], f"`{c}`")
        lift = 2 ** (_BITS[types[c]] - 2) + 1
        step = f"coalesce(CAST({whole} AS DECIMAL(20, 0)) + CAST('{lift}' AS DECIMAL(20, 0)), CAST(0 AS DECIMAL(20, 0)))"
        total = f"CAST({total} * CAST('{2 ** _BITS[types[c]]}' AS DECIMAL(20, 0)) + {step} AS DECIMAL(38, 0))"
    bits = min(free, 60)
    values = ", ".join(f"`{c}`" for c in cols)
    return F.expr(f"CAST({total} * CAST('{2 ** bits}' AS DECIMAL(19, 0)) + (xxhash64({values}) & {2 ** bits - 1}L) AS DECIMAL(38, 0))")


def latest_per_key(df: DataFrame, key: str, order: list[str], cols: list[str],
                   fill_zero=True) -> DataFrame:
    """The row of each key that is last in `order` (time first, then tie-breakers).

    As an aggregate it leaves one row per key and task before the shuffle, so a key with very
    many records sends only a few. Rows alike in `order` are told apart by their values, so
    the result does not depend on where rows lie: by a hash of them where time, tie-breakers and hash fit into
    one number of fixed width, which a hash aggregate can hold, else (text, or two long numbers in `order`) by the values themselves
    in a sort aggregate. `fill_zero` sets null numbers to 0.
    """
    packed = _packed(df, order, cols)
    if packed is not None:
        rows = (df.select(key, *cols, packed.alias("_packed")).groupBy(key)
                .agg(*(F.max_by(c, "_packed").alias(c) for c in cols)))
    else:
        newest = F.max(F.struct(*order, *(c for c in cols if c not in order)))
        rows = df.groupBy(key).agg(newest.alias("_newest")).select(key, *(f"_newest.{c}" for c in cols))
    return rows.na.fill(0.0, cols) if fill_zero else rows


def last_value_per_key(df: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    """Values at the greatest `ts` of each key, by aggregate; for a `ts` without ties."""
    return df.groupBy(key).agg(*(F.max_by(c, ts).alias(c) for c in cols))


def hits_per_key(df: DataFrame, key: str, is_hit: Column, hit_only=False) -> DataFrame:
    """`(key, event_count, hit_count)` for keys that are not null or blank.

    `hit_only` leaves out keys without a hit.
    """
    present = filled(key) if dict(df.dtypes)[key] == "string" else F.col(key).isNotNull()
    rows = df.filter(present & is_hit) if hit_only else df.filter(present)
    return rows.groupBy(key).agg(F.count("*").alias("event_count"),
                                 F.sum(flag(is_hit)).alias("hit_count"))


def peaks_per_key(df: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    """Largest values per key over rows that have all of them; `cols`: result name -> column."""
    return (df.select(key, *cols.values()).dropna(subset=list(cols.values())).groupBy(key)
            .agg(*(F.max(c).alias(name) for name, c in cols.items())))


def correlations(df: DataFrame, pairs: dict[str, tuple], names=("metric", "value"),
                 digits=None) -> DataFrame:
    """One row per named pair of columns, all pairs in one pass."""
    labels = list(pairs)
    one = df.agg(*(pearson(*pairs[label]).alias(f"c{i}") for i, label in enumerate(labels)))
    value = [F.col(f"c{i}") if digits is None else F.round(f"c{i}", digits)
             for i in range(len(labels))]
    return one.select(F.inline(F.array(*(
        F.struct(F.lit(label).alias(names[0]), value[i].alias(names[1]))
        for i, label in enumerate(labels)))))


def mean_by_quarter(detail: DataFrame, value, hits="hit_count") -> DataFrame:
    """Mean hits per quarter of a capacity as `(range, avg_evictions)`."""
    return (detail.groupBy(quarter(value).alias("range"))
            .agg(F.avg(hits).alias("avg_evictions")).orderBy("range"))


def capacity_vs_hits(capacity: DataFrame, hits: DataFrame, key: str,
                     values: dict[str, str]) -> dict[str, DataFrame]:
    """Joined detail, correlations and range means of capacities against hits.

    `values` maps a label to a capacity column. Both inputs have one row per key, so the
    join cannot fan out. Persist `detail` when several of the results are wanted.
    """
    return from_detail(capacity.join(hits, key), values)


def from_detail(detail: DataFrame, values: dict[str, str], hits="hit_count") -> dict[str, DataFrame]:
    return {
        "detail": detail,
        "correlations": correlations(detail, {n: (c, hits) for n, c in values.items()}),
        **{f"{c}_ranges": mean_by_quarter(detail, c, hits) for c in values.values()},
    }


def peaks_vs_counts(usage: DataFrame, events: DataFrame, key: str, cols: dict[str, str],
                    is_hit: Column, hit_only=False) -> DataFrame:
    """Peaks of each key beside its `event_count` and `hit_count`; keys in both inputs only."""
    return peaks_per_key(usage, key, cols).join(hits_per_key(events, key, is_hit, hit_only), key)


def first_rows(df: DataFrame, *order, n=20) -> DataFrame:
    """A fixed sample for reports: the first `n` rows in a stated order."""
    return df.orderBy(*order).limit(n)
