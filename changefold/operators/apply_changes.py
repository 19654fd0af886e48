"""Fold keyed changes into current state (SCD type 1) or history (SCD type 2), C1-C8 and C11.

Both folds depend on the set of changes only, not on their order or number of copies, so they can be
applied to a whole table, to each micro-batch, and again to their own results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefold.session import work_dir

DELETED, TRUNCATED, VALID_TO = "_deleted", "_truncated", "_valid_to"


@dataclass(frozen=True)
class ChangeSpec:
    """What the changes mean.

    `tie_breaker` orders changes of one key with an equal sequence. Rows meeting `ignore_when` are left out. `required` are
    the columns of the target that may not be NULL. `era`, for a history that is streamed into, is an expression of the
    sequence that never falls as it grows: versions of one key are stored apart by it, so that a hot key is many groups.
    """

    keys: tuple[str, ...]
    sequence_by: str
    tie_breaker: tuple[str, ...]
    delete_when: str
    truncate_when: str | None = None
    ignore_when: str | None = None
    except_columns: tuple[str, ...] = ()
    scd_type: int = 1
    required: tuple[str, ...] = ()
    era: str | None = None

    def __post_init__(self):
        if self.scd_type not in (1, 2):
            raise ValueError("scd_type is 1 or 2")
        if self.scd_type == 2 and self.truncate_when:
            raise ValueError("history has no truncate rule; use ignore_when to leave truncates out")
        if self.scd_type == 1 and self.era:
            raise ValueError("only a history has eras")
        if not self.keys or not self.tie_breaker:
            raise ValueError("keys and tie_breaker need at least one column each")


def apply_changes(
    changes: DataFrame,
    *,
    keys,
    sequence_by: str,
    tie_breaker,
    delete_when: str,
    truncate_when: str | None = None,
    ignore_when: str | None = None,
    except_columns=(),
    scd_type: int = 1,
) -> DataFrame:
    """Batch form: the target table that the whole frame of changes leads to."""
    spec = ChangeSpec(
        keys=tuple(keys),
        sequence_by=sequence_by,
        tie_breaker=tuple(tie_breaker),
        delete_when=delete_when,
        truncate_when=truncate_when,
        ignore_when=ignore_when,
        except_columns=tuple(except_columns),
        scd_type=scd_type,
    )
    return present(to_state(mark(changes, spec), spec), spec)


def rejected_changes(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Changes that no fold can place: without a sequence, or without a whole key."""
    exempt = _true(spec.truncate_when) | _true(spec.ignore_when)
    reason = F.when(F.col(spec.sequence_by).isNull(), "null_sequence").when(_keyless(spec) & ~exempt, "null_key")
    return changes.withColumn("reason", reason).where("reason IS NOT NULL")


def mark(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The placeable changes, with their rules evaluated. All truncates share the NULL key."""
    usable = changes.where(F.col(spec.sequence_by).isNotNull())
    if spec.ignore_when:
        usable = usable.where(~_true(spec.ignore_when))
    usable = usable.where(~_keyless(spec) | _true(spec.truncate_when))
    flagged = usable.withColumns({DELETED: _true(spec.delete_when), TRUNCATED: _true(spec.truncate_when)})
    if spec.truncate_when is None:
        return flagged
    return flagged.withColumns({k: F.when(~F.col(TRUNCATED), F.col(k)) for k in spec.keys})


def fold(marked: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Newest change per key (type 1) or per key and sequence (type 2), deletes included."""
    if spec.scd_type == 1:
        return newest(marked, spec.keys, (spec.sequence_by, *spec.tie_breaker))
    return newest(marked, (*spec.keys, spec.sequence_by), spec.tie_breaker)


def newest(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per group. Spark ranks before the shuffle too, so each task sends one row per group:
    a key or a group of copies with a large part of all rows is no longer large after that.
    """
    newest_first = Window.partitionBy(*group).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def to_state(marked: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Marked changes -> the rows a target keeps: type 2 gets its bounds, type 1 loses what a truncate cut."""
    return close_versions(marked, spec) if spec.scd_type == 2 else cut_truncated(fold(marked, spec), marked, spec)


def cut_truncated(folded: DataFrame, marked: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Keep what is newer than the newest truncate, and that truncate itself.

    The cut is one row by construction and becomes a scalar subquery over two columns.
    """
    if spec.truncate_when is None:
        return folded
    cut = marked.where(F.col(TRUNCATED)).agg(F.max(spec.sequence_by)).scalar()
    sequence = F.col(spec.sequence_by)
    return folded.where(F.coalesce(F.when(F.col(TRUNCATED), sequence >= cut).otherwise(sequence > cut), F.lit(True)))


def close_versions(marked: DataFrame, spec: ChangeSpec) -> DataFrame:
    """One row per key and sequence, with its end: the next sequence of the key, NULL while open.

    Whole rows are shuffled once, by key and sequence, so a hot key is spread like any other. The ends come from keys and
    sequences alone, sorted into ranges and written, for their ranges have to stay: within a range by the next row, across a
    border by the first row of the range after. Any sequence that can be sorted will do.
    """
    keys, sequence = list(spec.keys), spec.sequence_by
    path = f"{work_dir(marked.sparkSession, 'versions')}/ranges"
    ranged = marked.select(*keys, sequence).distinct().repartitionByRange(*keys, sequence)
    ranged = ranged.withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    versions = marked.sparkSession.read.schema(ranged.schema).parquet(path)

    firsts = versions.groupBy("_range").agg(F.min(F.struct(*keys, sequence)).alias("_first"))
    after = firsts.select("_range", F.lead("_first").over(Window.orderBy("_range")).alias("_next"))
    same_key = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_next.{k}") for k in keys])
    beyond = F.when(same_key, F.col(f"_next.{sequence}"))
    in_range = Window.partitionBy("_range", *keys).orderBy(sequence)
    ends = versions.withColumn(VALID_TO, F.lead(sequence).over(in_range)).join(F.broadcast(after), "_range")  # one row per range
    ends = ends.select(*keys, sequence, F.coalesce(VALID_TO, beyond).alias(VALID_TO))
    return fold(marked, spec).join(ends, [*keys, sequence])


def present(state: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Kept rows -> the target's own columns and rows."""
    live = state.where(~F.col(DELETED) & ~F.col(TRUNCATED))
    bookkeeping = {DELETED, TRUNCATED, VALID_TO, *spec.except_columns}
    columns = [*spec.keys, *[c for c in live.columns if c not in bookkeeping and c not in spec.keys]]
    if spec.scd_type == 1:
        return live.select(*columns)
    return live.select(*columns, F.col(spec.sequence_by).alias("valid_from"), F.col(VALID_TO).alias("valid_to"))


def _keyless(spec: ChangeSpec) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])


def _true(rule: str | None) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False)) if rule else F.lit(False)
