"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import scratch_path

# The word and line separators of the contracts (blank and the five
# ASCII controls from tab to carriage return).
BLANKS = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables (a file or a folder of part files), whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage is cut, any
    executor can read the result after a loss, and the planner knows its size (so it
    broadcasts a small side by itself)."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], stem: str) -> str:
    """A column name that none of ``columns`` bears, in any case of letters."""
    taken = {c.lower() for c in columns}
    return next(n for n in (f"{stem}_{k}" for k in count()) if n.lower() not in taken)


def apart(operator: Callable) -> Callable:
    """An operator whose first argument is a frame that passes through, made safe for columns whose names begin
    with two underscores, as the operators' own do: for the time of the call they bear free names.  A
    column that the operator adds must not be there under that name (``ValueError``)."""
    @wraps(operator)
    def run(docs: DataFrame, *args, **how):
        own = [c for c in docs.columns if c.startswith("__")]
        if not own:
            return operator(docs, *args, **how)
        taken = {c.lower() for c in docs.columns}
        stem = next(f"passing{k}x" for k in count() if not any(c.startswith(f"passing{k}x") for c in taken))
        free = {c: f"{stem}{i}" for i, c in enumerate(own)}
        named = lambda v: free.get(v, v) if isinstance(v, str) else v  # noqa: E731 - a column named by an argument
        out = operator(docs.withColumnsRenamed(free), *map(named, args), **{k: named(v) for k, v in how.items()})
        added = {c.lower() for c in out.columns}
        twice = [c for c in own if c.lower() in added]
        if twice:
            raise ValueError(f"the operator adds columns of these names: {twice}")
        return out.withColumnsRenamed({b: a for a, b in free.items()})
    return run


def by_group(keys: list[str], fn: Callable) -> Callable:
    """A ``mapInPandas`` function that calls ``fn(pdf)`` once for each run of equal keys.

    The input must be sorted by ``keys`` within its partitions.  At most one group and one
    Arrow batch are held; callers bound the groups with :func:`block_pairs`."""
    import pandas as pd

    def run(batches):
        held, last, out = [], None, []

        def close():
            made = fn(pd.concat(held) if len(held) > 1 else held[0])
            held.clear()
            if made is not None and len(made):
                out.append(made)

        for pdf in batches:
            if not len(pdf):
                continue
            cols = [pdf[k].to_numpy() for k in keys]
            new = np.zeros(len(pdf), dtype=bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            if held and tuple(c[0] for c in cols) != last:
                close()
            cuts = [0, *np.flatnonzero(new).tolist(), len(pdf)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a:
                    close()
                held.append(pdf.iloc[a:b])
            last = tuple(c[-1] for c in cols)
            if out:
                yield pd.concat(out) if len(out) > 1 else out[0]
                out.clear()
        if held:
            close()
        yield from out

    return run


def block_pairs(df: DataFrame, keys: list[str], size: str, member: Column, block: int) -> DataFrame:
    """Deal each group out over tasks in pairs of blocks of about ``block`` rows.

    A group of ``size`` rows gets ``nb = ceil(size / block)`` blocks by a hash of ``member``;
    every row goes to the ``nb`` pairs its block is part of.  Adds ``bi <= bj`` (the pair)
    and ``side`` (the row's own block).  Every pair of rows meets in exactly one block
    pair, and no task holds more than about two blocks, however large the group."""
    nb = F.greatest(F.lit(1), F.ceil(F.col(size) / F.lit(block))).cast("int")
    out = (df.withColumn("__nb", nb)
           .withColumn("side", F.pmod(F.xxhash64(member), F.col("__nb")).cast("int"))
           .withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__nb") - 1))))
    return (out.withColumn("bi", F.least("side", "__o")).withColumn("bj", F.greatest("side", "__o"))
            .drop("__nb", "__o"))


def bound_for_broadcast(df: DataFrame, rows: int, most: int) -> DataFrame:
    """``df`` with a broadcast hint when its counted ``rows`` are at most ``most``; as it is
    (the planner shuffles and splits skewed partitions) beyond that."""
    return F.broadcast(df) if rows <= most else df
