"""V3 that names the rows: source and sink compared through invertible Bloom lookup tables.

Each side is summed up in :data:`CELLS` cells per event kind and hour: a row adds to one cell of each
third its count, by exclusive or its UUID, time and a check, and a second check times its count.  Subtracting the sink's cells from
the source's cancels every row that both have.  What is left is peeled: a cell that holds one
row names it, the row is taken out of its other cells, and so on.  The tables grow with kinds
and hours, not with rows, so they can be stored with a table and compared without it.

A kind and hour with more differences than its cells can name, and ids that are no UUIDs, are
compared row by row: the result is whole whatever the number of losses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.encode import uuid_text
from eventlake.session import cut_lineage

GROUP = ["Name", "hour"]
WORDS = ["high", "low", "us"]
XORED = [*WORDS, "proof"]
SUMS = ["n", *XORED, "weight"]      # weight: the sum of n times a 32-bit hash, which tells copies from their absence
CELLS = 96
THIRDS = 3
CANONICAL = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def _rows(events: DataFrame) -> DataFrame:
    """Kind, hour and key of each event; ``plain`` if the id is a UUID and there is a time."""
    own = events.select(F.col("Name"), F.date_trunc("hour", "Timestamp").alias("hour"), F.col("UUID"), F.col("Timestamp"))
    return own.withColumn("plain", F.coalesce(F.col("UUID").rlike(CANONICAL), F.lit(False)) & F.col("Timestamp").isNotNull())


def _word(digits: Column) -> Column:
    """Sixteen hex digits as a signed 64-bit number."""
    return F.conv(digits, 16, -10).cast("long")


def _proof() -> Column:
    return F.xxhash64(*WORDS, F.lit(1))


def _weight() -> Column:
    return F.col("n") * F.xxhash64(*WORDS, F.lit(2)).bitwiseAND(F.lit(0xFFFFFFFF))


def _cells(rows: DataFrame, cells: int) -> DataFrame:
    """``rows`` (group, words, n) added to their cells."""
    third = cells // THIRDS
    places = F.array(*[(F.pmod(F.xxhash64(*WORDS, F.lit(10 + t)), F.lit(third)) + t * third).cast("int") for t in range(THIRDS)])
    each = rows.withColumn("proof", _proof()).withColumn("weight", _weight()).withColumn("cell", F.explode(places))
    return each.select(*GROUP, "cell", *SUMS)


def _summed(cells: DataFrame) -> DataFrame:
    out = cells.groupBy(*GROUP, "cell").agg(F.sum("n").alias("n"), *[F.bit_xor(c).alias(c) for c in XORED],
                                            F.sum("weight").alias("weight"))
    return out.where(" or ".join(f"{c} <> 0" for c in SUMS))


def table_of(events: DataFrame, cells: int = CELLS) -> DataFrame:
    """The lookup table of ``events``: (Name, hour, cell, n, high, low, us, proof, weight).  A partial aggregate; store it
    to compare the table later, or elsewhere.  Ids that are no UUIDs are not in it."""
    if cells < THIRDS:
        raise ValueError("at least a cell for each third")
    digits = F.regexp_replace("UUID", "-", "")
    rows = _rows(events).where("plain").select(
        *GROUP, _word(F.substring(digits, 1, 16)).alias("high"), _word(F.substring(digits, 17, 16)).alias("low"),
        F.unix_micros("Timestamp").alias("us"), F.lit(1).cast("long").alias("n"))
    return _summed(_cells(rows, cells))


def subtract(source: DataFrame, sink: DataFrame) -> DataFrame:
    """The cells in which two lookup tables (of one number of cells) differ."""
    minus = sink.select(*GROUP, "cell", (-F.col("n")).alias("n"), *XORED, (-F.col("weight")).alias("weight"))
    return _summed(source.select(*GROUP, "cell", *SUMS).unionByName(minus))


def decode(difference: DataFrame, cells: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """The rows that a difference names (group, words, n: 1 lost, -1 extra), and the groups that it cannot name
    whole.  Rounds of joins over what still differs, each written; a group's rows that were named before it
    got stuck are not in the first."""
    left = cut_lineage(difference, "reconcile-cells")
    named, size = None, left.count()
    while True:
        one = (F.abs("n") == 1) & (F.col("proof") == _proof()) & (F.col("weight") == _weight())
        alone = cut_lineage(left.where(one).select(*GROUP, *WORDS, "n").distinct(), "reconcile-named")
        if not size or not alone.limit(1).count():
            break
        gone = _cells(alone.withColumn("n", -F.col("n")), cells)
        rest = cut_lineage(_summed(left.unionByName(gone.select(*left.columns))), "reconcile-cells")
        before, size = size, rest.count()
        if size >= before:                      # nothing was gained: what is left is stuck
            break
        left, named = rest, alone if named is None else named.unionByName(alone)
    stuck = cut_lineage(left.select(*GROUP).distinct(), "reconcile-stuck")
    if named is None:
        return alone, stuck
    # a row that was named in one round and again in a later one cancels itself
    whole = named.groupBy(*GROUP, *WORDS).agg(F.sum("n").alias("n")).where("n <> 0")
    return whole.join(stuck, _same(whole, stuck, GROUP), "left_anti"), stuck


def _same(a: DataFrame, b: DataFrame, columns) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def _exact(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Differences row by row: (Name, UUID, Timestamp, n), n > 0 lost, n < 0 extra."""
    both = source.select("Name", "UUID", "Timestamp", F.lit(1).cast("long").alias("n")).unionByName(
        sink.select("Name", "UUID", "Timestamp", F.lit(-1).cast("long").alias("n")))
    return both.groupBy("Name", "UUID", "Timestamp").agg(F.sum("n").alias("n")).where("n <> 0")


def reconcile(source: DataFrame, sink: DataFrame, cells: int = CELLS, source_table: DataFrame | None = None,
              sink_table: DataFrame | None = None) -> DataFrame:
    """Every event that one side has more often than the other: (Name, UUID, Timestamp, side ``lost`` or
    ``extra``, copies).  Lookup tables that are stored are given instead of being made.

    Events are equal by kind, id and time.  Null kinds, ids and times are values like others."""
    difference = subtract(table_of(source, cells) if source_table is None else source_table,
                          table_of(sink, cells) if sink_table is None else sink_table)
    named, stuck = decode(difference, cells)
    digits = F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("high", "low")]))
    found = named.select("Name", uuid_text(digits).alias("UUID"), F.timestamp_micros("us").alias("Timestamp"), "n")
    a, b = _rows(source), _rows(sink)

    def rest(rows: DataFrame) -> DataFrame:
        return rows.where("plain").join(stuck, _same(rows, stuck, GROUP), "left_semi").unionByName(rows.where("not plain"))

    found = found.unionByName(_exact(rest(a), rest(b)))
    return found.select("Name", "UUID", "Timestamp", F.when(F.col("n") > 0, "lost").otherwise("extra").alias("side"),
                        F.abs("n").alias("copies"))
