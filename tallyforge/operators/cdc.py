"""Change-feed operators: live-row filter, latest version per key, change apply.

``latest_by_key`` is the one "newest row per key" operator used by every
silver model. It is written as a grouped ``max`` over a struct whose leading
fields are the ordering columns, instead of ``row_number()`` over a window:

* one shuffle on the key, and a partial (map-side) aggregate before it, so a
  key that holds a third of all rows is reduced to one row per map task
  before anything moves — no task ever sorts or buffers a whole hot key;
* the output is hash-partitioned on the key, which later joins on the same key
  reuse without another exchange.

With strings in the payload Spark runs this as a sort aggregate. The other way, a hash
aggregate of a fixed-width order key and a shuffled hash join of the payload by (key,
order), was measured on 6 million rows of 200 bytes, local[8]: 11.9 s against 5.4 s with
1.2 versions a key, 11.4 s against 5.3 s with 6. It moves every version's payload and
loses the partitioning by key, so this form stays.

Ordering semantics: the ordering columns compare descending with NULLs last
(a NULL never beats a value); the remaining columns (tie-break columns first)
break exact ties, so the result is deterministic. All payload columns must be
orderable types (no maps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETED = "_deleted"


def is_live(flag: str = DELETED) -> Column:
    """``coalesce(flag, false) = false``: a NULL flag counts as live."""
    return ~F.coalesce(F.col(flag), F.lit(False))


def live_rows(df: DataFrame, flag: str = DELETED) -> DataFrame:
    return df.filter(is_live(flag))


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _newest(df: DataFrame, keys: list[str], order: list[str], tiebreak: list[str]) -> DataFrame:
    """Grouped max over struct(order..., tiebreak..., rest...) -> one row per key."""
    payload = [c for c in df.columns if c not in keys]
    rank = order + [c for c in tiebreak if c not in order]
    rest = [c for c in payload if c not in rank]
    names = {c: f"_{i}" for i, c in enumerate(rank + rest)}
    packed = F.struct(*[F.col(c).alias(names[c]) for c in rank + rest])
    return (df.groupBy(*keys).agg(F.max(packed).alias("_newest"))
              .select(*keys, *[F.col("_newest").getField(names[c]).alias(c) for c in payload]))


def latest_by_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str,
                  tiebreak: Sequence[str] | str | None = None,
                  tombstones: str = "resurface", flag: str = DELETED) -> DataFrame:
    """Newest row per key.

    tombstones="resurface": deleted rows are removed first, so a key whose newest
    version is a tombstone comes back with its newest live version (the contract
    of the silver models). tombstones="drop_key": the newest version wins even if
    it is a tombstone, and such keys are dropped (true CDC delete).
    """
    keys, order, tiebreak = _as_list(keys), _as_list(order), _as_list(tiebreak)
    if tombstones not in ("resurface", "drop_key"):
        raise ValueError("tombstones must be 'resurface' or 'drop_key'")
    has_flag = flag in df.columns
    if tombstones == "resurface" and has_flag:
        df = live_rows(df, flag)
    out = _newest(df, keys, order, tiebreak)
    if tombstones == "drop_key" and has_flag:
        out = live_rows(out, flag)
    return out


def apply_changes(state: DataFrame | None, changes: DataFrame, keys: Sequence[str] | str,
                  order: Sequence[str] | str, tiebreak: Sequence[str] | str | None = None) -> DataFrame:
    """Fold a batch of change rows into the current state (newest per key wins).

    State keeps tombstones (rows with the delete flag) so that an older version
    arriving late can never resurrect a deleted key, and a re-delivered row is a
    no-op. Because "newest per key" is associative and commutative, applying k
    batches in any order equals applying their union once. Read the live rows of
    a state with :func:`live_view`.
    """
    merged = changes if state is None else state.unionByName(changes)
    return _newest(merged, _as_list(keys), _as_list(order), _as_list(tiebreak))


_EPOCH = "1970-01-01 00:00:00"
_TS_SHIFT = 10 ** 17          # Spark timestamps span about -6.2e16 .. 2.6e17 microseconds
_ID_SHIFT = 2 ** 63 + 1       # a shifted 64-bit id lies in 1 .. 2**64 < 10**20


def newest_first_key(ts: str, id_col: str) -> Column:
    """Exact single-value ordering key for (timestamp, 64-bit id), NULLs lowest.

    ``decimal(38,0)`` = (microseconds + 1e17) * 1e20 + (id + 2**63 + 1); both parts
    fit their digit ranges for every Spark timestamp and long, so ordering by the
    key equals ordering by the pair. Unlike a struct it is a fixed-width
    aggregation buffer, so ``max_by(value, key)`` stays a hash aggregate.
    """
    dec = "decimal(38,0)"

    def big(n: int) -> Column:       # constants above 2**63 travel as text
        return F.lit(str(n)).cast(dec)

    us = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    ts_part = F.coalesce(us.cast(dec) + big(_TS_SHIFT), big(0))
    id_part = F.coalesce(F.col(id_col).cast(dec) + big(_ID_SHIFT), big(0))
    return (ts_part * big(10 ** 20) + id_part).cast(dec)


def live_view(state: DataFrame, flag: str = DELETED) -> DataFrame:
    """Rows of an applied state whose newest version is not a tombstone."""
    return live_rows(state, flag)
