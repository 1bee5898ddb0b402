"""Left joins that keep every match and stay balanced on hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import mul, or_, truediv

from pyspark.sql import Column, DataFrame, Window, functions as F


# Row counts of a fan-out outgrow 64 bits.
_BIG = "decimal(38,0)"

# Rows without a key match nothing, so each may go to any task.
_ANYWHERE = 1 << 30

# Rows of a side that a joined row's loop goes over at once.
_BLOCK = 64


@dataclass(frozen=True)
class Skew:
    """When a key counts as hot: its output rows are more than one task should write.

    A hot key is cut into pieces of about ``rows_a_task`` output rows, so there is at most
    one hot key for every ``rows_a_task`` rows of the output.  ``target_tasks`` takes that
    share of a join's output instead, which needs the sum over all keys.
    """

    target_tasks: int | None = None
    rows_a_task: int = 5_000_000

    def piece(self, work: DataFrame) -> Column:
        """Output rows of a piece, for keys with ``_work`` output rows each."""
        if self.target_tasks is None:
            return F.lit(float(self.rows_a_task))
        return work.agg(F.sum("_work")).scalar().cast("double") / F.lit(self.target_tasks)


def _grid(work: Column, piece: Column, left: Column, right: Column) -> tuple[Column, Column]:
    """Into how many parts the left and the right rows of a key are dealt: near squares."""
    whole = F.lit(1.0)
    pieces = F.greatest(whole, F.ceil(work / piece))
    square = F.ceil(F.sqrt(pieces * left / right))
    lcut = F.least(left, pieces, F.greatest(square, whole))
    return lcut.cast("int"), F.least(right, F.ceil(pieces / lcut)).cast("int")


def key_rows(side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each key, counted before they move."""
    return side.groupBy(*keys).agg(F.count(F.lit(1)).cast(_BIG).alias("_rows"))


def joined_key_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each key after a left join, from the ``key_rows`` of its sides."""
    each = F.coalesce(F.col("_right_rows"), F.lit(1))
    both = left.join(right.withColumnRenamed("_rows", "_right_rows"), list(keys), "left")
    return both.select(*keys, (F.col("_rows") * each).cast(_BIG).alias("_rows"))


def _hot_keys(
    left_rows: DataFrame, right_rows: DataFrame | None, keys: list[str], skew: Skew
) -> DataFrame:
    """The hot keys, and into how many pieces each side's rows of the key are dealt."""
    one = F.lit(1).cast(_BIG)
    if right_rows is None:
        sides = left_rows.withColumn("_r", one)
    else:
        sides = left_rows.join(right_rows.withColumnRenamed("_rows", "_r"), keys, "full")
    sides = sides.select(
        *keys, F.coalesce("_rows", one).alias("_l"), F.coalesce("_r", one).alias("_r")
    )
    work = sides.withColumn("_work", (F.col("_l") * F.col("_r")).cast(_BIG))
    piece = skew.piece(work)
    rows = F.col("_work").cast("double")
    lcut, rcut = _grid(rows, piece, F.col("_l").cast("double"), F.col("_r").cast("double"))
    return work.where(rows > piece).select(*keys, lcut.alias("_lcut"), rcut.alias("_rcut"))


def skew_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: Column,
    right_id: Column | None = None,
    left_rows: DataFrame | None = None,
    skew: Skew = Skew(),
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)``, with hot keys cut into pieces.

    ``left_rows`` gives the ``key_rows`` of the left side where they follow from a table that
    is cheaper to scan, as after an earlier join.  ``right_id=None`` states that ``keys`` are
    unique on the right.  The plan is the same at every size and runs nothing by itself.
    """
    keys = list(keys)
    left_rows = key_rows(left, keys) if left_rows is None else left_rows
    right_rows = None if right_id is None else key_rows(right, keys)
    hot = _hot_keys(left_rows, right_rows, keys, skew)
    return _pieced_left_join(left, right, keys, left_id, right_id, hot)


def _pieced_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_id: Column,
    right_id: Column | None,
    hot: DataFrame,
) -> DataFrame:
    """Left join in which the keys of ``hot`` are spread over many tasks.

    A hot left key has its left rows dealt over ``_lcut`` pieces and its right rows
    copied to each; a hot right key the other way round; a key hot on both sides uses
    a grid.  Every pair meets exactly once.  Rows are dealt by a hash of their id, so
    a retried task deals them alike.
    """
    hot = F.broadcast(hot)
    no_key = reduce(or_, (F.col(key).isNull() for key in keys))
    one = F.lit(1)
    left_cut, right_cut = F.coalesce("_lcut", one), F.coalesce("_rcut", one)

    def dealt(row_id: Column, cut: Column) -> Column:
        return F.pmod(F.xxhash64(row_id), cut).cast("int")

    def copies(cut: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), cut - 1))

    spread = F.when(no_key, F.lit(_ANYWHERE)).otherwise(left_cut)
    l = left.join(hot, keys, "left").select(
        *left.columns, right_cut.alias("_rcut"), dealt(left_id, spread).alias("_i")
    )
    r = right.where(~no_key).join(hot, keys, "left").withColumn("_i", copies(left_cut))
    if right_id is None:
        return l.drop("_rcut").join(r.drop("_lcut", "_rcut"), [*keys, "_i"], "left").drop("_i")

    l = l.withColumn("_j", copies(F.col("_rcut")))
    r = r.withColumns({"_j": dealt(right_id, right_cut), "_matched": F.lit(True)})
    joined = l.join(r.drop("_lcut", "_rcut"), [*keys, "_i", "_j"], "left")
    # A key hot on the right surely matches in some piece; its copies that met an empty
    # piece are not unmatched rows.
    return joined.where((F.col("_rcut") == 1) | F.col("_matched").isNotNull()).drop(
        "_i", "_j", "_rcut", "_matched"
    )


def chain_key_rows(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of each key in every table, as ``_n0``, ``_n1`` and so on: one scan a table, one shuffle.

    Counted before they move: a key is one row a task, however often it stands.
    """
    def own(table: DataFrame, index: int) -> DataFrame:
        here = (F.lit(int(at == index)).cast("bigint").alias(f"_n{at}") for at in range(len(tables)))
        return table.select(*keys, *here)

    every = reduce(DataFrame.unionByName, (own(table, index) for index, table in enumerate(tables)))
    counts = every.groupBy(*keys).agg(*(F.sum(f"_n{at}").alias(f"_n{at}") for at in range(len(tables))))
    # Rows without a key go here and not before: a condition on a key alone would be moved to the
    # scan and make the key, a hash, twice for every row.
    return counts.where(F.when(_no_key(keys), F.lit(False)).otherwise(F.col("_n0") >= 0))


def _no_key(keys: Sequence[str]) -> Column:
    return reduce(or_, (F.col(key).isNull() for key in keys))


def _chain_cuts(counts: DataFrame, keys: Sequence[str], tables: int, skew: Skew) -> DataFrame:
    """The hot keys of a chain, and into how many parts ``_cut0``, ``_cut1``, … each table's rows are dealt.

    A part of every table meets in a piece.  Rows are copied least where parts are of equal
    size; a table with fewer rows stays whole, and the others share what it leaves.
    """
    each = [F.greatest(F.col(f"_n{at}"), F.lit(1)).cast("double") for at in range(tables)]
    work = reduce(mul, each)
    piece = skew.piece(counts.select(work.alias("_work")))
    ordered = F.array_sort(F.array(*each))
    # the product of min(rows, part) over the tables is a piece, whichever tables stay whole
    part = F.greatest(*(
        F.pow(reduce(truediv, (ordered[small] for small in range(whole)), piece), F.lit(1.0 / (tables - whole)))
        for whole in range(tables)
    ), F.lit(0.0))
    cuts = (F.least(n, F.ceil(n / part)).cast("int").alias(f"_cut{at}") for at, n in enumerate(each))
    return counts.where(work > piece).select(*keys, *cuts)


def skew_left_joins(
    left: DataFrame,
    sides: Sequence[tuple[DataFrame, Column]],
    keys: Sequence[str],
    left_id: Column,
    counted: DataFrame | None = None,
    skew: Skew = Skew(),
) -> DataFrame:
    """``left LEFT JOIN side1 USING (keys) LEFT JOIN side2 …``, with hot keys cut into pieces.

    Each side comes with the id of its rows.  The rows of each key are counted once for the
    whole chain; the hot keys, one for every ``skew.rows_a_task`` rows of the output at most,
    are attached to each table by one and the same broadcast.  ``counted`` has the keys of
    ``left`` where a cheaper table has them too.

    All tables are dealt once, by key and place in one grid with an axis a table, so what
    moves is the tables: joined rows stay in the task that makes them.  A hot key's rows have
    their place on the axis of their table by a hash of their id and are copied along the
    others; place 0 is that of all rows of a table that isn't cut.

    The joins meet ``left`` with blocks of a side's rows, not with single ones: blocks are
    few, and joined rows are made last, by one loop over the blocks that a left row has met.
    """
    keys = list(keys)
    tables = [left if counted is None else counted, *(side for side, _ in sides)]
    counts = chain_key_rows([table.select(*keys) for table in tables], keys)
    # met by <=>, as = would have the optimizer ask for the key where it is made, see chain_key_rows
    hot = _chain_cuts(counts, keys, len(tables), skew).withColumnsRenamed({key: f"_hot_{key}" for key in keys})
    hot = F.broadcast(hot)
    axes = [f"_at{at}" for at in range(len(tables))]
    # Adaptive execution would put parts together by the bytes they read, which say nothing of
    # the rows they become.
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def placed(rows: DataFrame, row_id: Column, own: int) -> DataFrame:
        found = rows.join(hot, [rows[key].eqNullSafe(hot[f"_hot_{key}"]) for key in keys], "left")
        found = found.withColumn("_dealt", F.xxhash64(row_id))
        for at, axis in enumerate(axes):
            cut = F.col(f"_cut{at}")
            if at == own:
                place = F.when(cut > 1, (F.pmod("_dealt", cut) + 1).cast("int")).otherwise(0)
                if own == 0:
                    spread = F.pmod("_dealt", F.lit(_ANYWHERE)).cast("int")
                    place = F.when(_no_key(keys), spread).otherwise(place)
            else:
                place = F.explode(F.when(cut > 1, F.sequence(F.lit(1), cut)).otherwise(F.array(F.lit(0))))
            found = found.withColumn(axis, place)
        return found.select(*rows.columns, *axes).repartition(parts, *keys, *axes)

    rows = placed(left, left_id, 0)
    names = [*keys, *(name for name in left.columns if name not in keys)]
    met = []
    for at, (side, side_id) in enumerate(sides, 1):
        theirs = _blocks(placed(side.where(~_no_key(keys)), side_id, at), [*keys, *axes], f"_block{at}")
        # a broadcast side would leave the rows undealt, and its matches to move for the next one
        rows = rows.join(theirs.hint("merge"), [*keys, *axes], "left")
        # A key hot on the right surely matches in some piece; its copies that met an empty
        # piece are not unmatched rows.
        met.append((F.col(axes[at]) == 0) | F.col(f"_block{at}").isNotNull())
    # A stage of generated code holds all that it makes of a row before it hands on any.  forall()
    # isn't part of such a stage, so what is held at once is made of one block a side.
    rows = rows.where(F.forall(F.array(*met), lambda ok: ok))
    for at, (side, _) in enumerate(sides, 1):
        later = [f"_block{more}" for more in range(at + 1, len(tables))]
        rows = rows.select(*names, *later, F.inline_outer(f"_block{at}"))
        names += [name for name in side.columns if name not in keys]
    return rows.select(*names)


def _blocks(rows: DataFrame, together: Sequence[str], name: str) -> DataFrame:
    """Rows that are alike in ``together``, as arrays of at most ``_BLOCK`` of them.

    ``rows`` are dealt by ``together``; they don't move.
    """
    alike = Window.partitionBy(*together).orderBy(*together)
    numbered = rows.withColumn("_block", F.floor((F.row_number().over(alike) - 1) / _BLOCK))
    others = F.struct(*(column for column in rows.columns if column not in together))
    return numbered.groupBy(*together, "_block").agg(F.collect_list(others).alias(name)).drop("_block")


def grid_lookup(
    rows: DataFrame, dim: DataFrame, value: str, low: str, high: str, per_unit: int
) -> DataFrame:
    """Left join to the closed interval a value lies in, as a hash join.

    ``dim`` is a hand-written dimension of a few disjoint intervals.  Intervals and values
    meet by the cell of ``1 / per_unit`` they reach into, and are compared there: any value
    and any ends are placed exactly, a value in a gap matches nothing, and ``per_unit`` only
    decides how many intervals a cell has.  Intervals with a NULL end match nothing.
    """
    def cell(number: str) -> str:
        return f"CAST(floor({number} * {per_unit}) AS bigint)"

    ends = dim.where(f"{low} IS NOT NULL AND {high} IS NOT NULL").selectExpr(
        "*", f"explode(sequence({cell(low)}, {cell(high)})) AS _cell"
    )
    located = rows.selectExpr("*", f"{value} AS _value").selectExpr("*", f"{cell('_value')} AS _at")
    inside = (F.col("_at") == F.col("_cell")) & F.col("_value").between(F.col(low), F.col(high))
    return located.join(F.broadcast(ends), inside, "left").drop("_at", "_cell", "_value")
