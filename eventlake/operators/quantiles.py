"""Exact nearest-rank percentiles per group, without gathering any group in one task.

The nearest-rank p-percentile of n values is the value at 1-based rank ceil(p * n)
of the sorted values (the smallest value whose cumulative share reaches p).  It is
found by radix selection on the bits of an order-preserving 64-bit key:

1. ``(group, value) -> count`` with a map-side partial aggregate (a hot group
   collapses to its distinct values), then cut lineage by writing it to the shared
   checkpoint folder, because every pass re-reads it.
2. Per pass, restrict to the values whose leading bits equal each target's chosen
   prefix, histogram the next ``digit_bits`` bits per (group, p) and pick the digit
   where the running count reaches the remaining rank.  A histogram has at most
   2^digit_bits rows per target, so its window is bounded whatever the group size.
3. Leading bits that every value shares are skipped; the value range is observed
   during the write of step 1 (no extra job).

Every pass is a join of the counts with the (groups x percentiles) target table,
which AQE broadcasts when it is small and otherwise shuffles with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.session import cut_lineage

# The sign bit, flipped so that signed order equals unsigned bit order.
SIGN_BIT = -(1 << 63)
DIGIT_BITS = 16
# IEEE-754 binary64 layout (52 mantissa bits, exponent bias 1023).
MANTISSA_BITS = 52
EXPONENT_BIAS = 1023
MIN_NORMAL = 2.2250738585072014e-308          # 2^-1022
MIN_SUBNORMAL_EXP = -1074


def double_key(x: Column) -> Column:
    """Order-preserving signed 64-bit key of a double: its IEEE-754 bits (computed with
    exact power-of-two arithmetic), negated for negative values.  -0.0 maps to +0.0;
    NaN maps above +infinity (Spark's ordering)."""
    a = F.abs(x)
    e0 = F.floor(F.log2(a))
    e = (F.when(F.pow(F.lit(2.0), e0) > a, e0 - 1)
         .when(F.pow(F.lit(2.0), e0 + 1) <= a, e0 + 1).otherwise(e0))
    mant_scale = float(1 << MANTISSA_BITS)
    normal_bits = (F.shiftleft((e + EXPONENT_BIAS).cast("bigint"), MANTISSA_BITS)
                   .bitwiseOR(((a / F.pow(F.lit(2.0), e) - 1) * mant_scale).cast("bigint")))
    subnormal_bits = (a / F.pow(F.lit(2.0), F.lit(MIN_SUBNORMAL_EXP))).cast("bigint")
    inf_bits = F.lit(0x7FF << MANTISSA_BITS).cast("bigint")
    nan_bits = F.lit((0x7FF << MANTISSA_BITS) | (1 << (MANTISSA_BITS - 1))).cast("bigint")
    bits = (F.when(F.isnan(x), nan_bits)
            .when(a == float("inf"), inf_bits)
            .when(a >= MIN_NORMAL, normal_bits)
            .otherwise(subnormal_bits))
    return F.when(x.isNull(), F.lit(None).cast("bigint")).when(
        F.isnan(x) | (x >= 0), bits).otherwise(-bits - 1)


def key_double(k: Column) -> Column:
    """Inverse of :func:`double_key`."""
    bits = F.when(k >= 0, k).otherwise(-k - 1)
    biased = F.shiftright(bits, MANTISSA_BITS)
    mant = bits.bitwiseAND(F.lit((1 << MANTISSA_BITS) - 1))
    mant_scale = float(1 << MANTISSA_BITS)
    a = (F.when((biased == 0x7FF) & (mant != 0), F.lit(float("nan")))
         .when(biased == 0x7FF, F.lit(float("inf")))
         .when(biased == 0, mant.cast("double") * F.pow(F.lit(2.0), F.lit(MIN_SUBNORMAL_EXP)))
         .otherwise((F.lit(1.0) + mant.cast("double") / mant_scale)
                    * F.pow(F.lit(2.0), (biased - EXPONENT_BIAS).cast("double"))))
    return F.when(k >= 0, a).otherwise(-a)


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      percentiles: Sequence[float], weight_col: str | None = None,
                      digit_bits: int = DIGIT_BITS, materialize: bool = True,
                      bounds: tuple[int | None, int | None] | None = None,
                      salt_buckets: int = 0) -> DataFrame:
    """Rows ``(group..., percentile, value)``: exact nearest-rank percentiles of an
    integral, decimal (up to 18 digits) or floating column per group (NULL values ignored;
    groups with none are absent; floating values go through :func:`double_key`, NaN ranks
    last; decimals through their unscaled value).
    ``weight_col`` gives a multiplicity per row (input already counted by value).
    ``bounds`` = (min, max) of the values, when the caller already knows them.
    ``salt_buckets`` > 0 salts the counts side of each pass's join (targets replicated that
    many times), so a hot group's values spread over that many tasks even without AQE's
    skew-join splitting."""
    if 64 % digit_bits:
        raise ValueError("digit_bits must divide 64")
    g = list(group_cols)
    spark = df.sparkSession
    vtype = df.schema[value_col].dataType
    if isinstance(vtype, T.DecimalType):
        if vtype.precision > 18:
            raise ValueError("exact percentiles take decimals of at most 18 digits")
        scale = 10 ** vtype.scale                 # unscaled value: exact in 64 bits
        keyed = df.withColumn("_dkey", (F.col(value_col) * F.lit(scale)).cast("bigint"))
        out = exact_percentiles(keyed, group_cols, "_dkey", percentiles, weight_col, digit_bits,
                                materialize, None, salt_buckets)
        return out.withColumn("value", (F.col("value").cast(T.DecimalType(18, 0))
                                        / F.lit(scale)).cast(vtype))
    if isinstance(vtype, (T.FloatType, T.DoubleType)):
        keyed = df.withColumn("_dkey", double_key(F.col(value_col).cast("double")))
        out = exact_percentiles(keyed, group_cols, "_dkey", percentiles, weight_col, digit_bits,
                                materialize, None, salt_buckets)
        return out.withColumn("value", key_double(F.col("value")))
    if not g:                       # one global group: a constant key keeps every join an equi-join
        out = exact_percentiles(df.withColumn("_all", F.lit(0)), ["_all"], value_col, percentiles,
                                weight_col, digit_bits, materialize, bounds, salt_buckets)
        return out.drop("_all")
    w = F.lit(1).cast("bigint") if weight_col is None else F.col(weight_col).cast("bigint")
    counts = (df.select(*g, F.col(value_col).cast("bigint").alias("_v"), w.alias("_w"))
              .filter(F.col("_v").isNotNull())
              .groupBy(*g, "_v").agg(F.sum("_w").alias("_c"))
              .select(*g, F.col("_v").bitwiseXOR(F.lit(SIGN_BIT)).alias("_u"), "_c"))
    if materialize:
        # the value range is observed while the counts are written: no extra job
        counts, observed = cut_lineage(counts, "value-counts", metrics={
            "lo": F.min(F.col("_u").bitwiseXOR(F.lit(SIGN_BIT))),
            "hi": F.max(F.col("_u").bitwiseXOR(F.lit(SIGN_BIT)))})
        bounds = (observed["lo"], observed["hi"])
    elif bounds is None:
        b = counts.agg(F.min(F.col("_u").bitwiseXOR(F.lit(SIGN_BIT))).alias("lo"),
                       F.max(F.col("_u").bitwiseXOR(F.lit(SIGN_BIT))).alias("hi")).first()
        bounds = (b.lo, b.hi)

    # leading bits shared by every value: skip the passes that would only confirm them
    lo, hi = bounds
    if lo is None:
        schema = ", ".join([f"`{c}` {t}" for c, t in counts.select(*g).dtypes]
                           + ["percentile double", "value bigint"])
        return spark.createDataFrame([], schema)
    ulo, uhi = lo ^ SIGN_BIT, hi ^ SIGN_BIT                        # as unsigned python ints
    ulo &= (1 << 64) - 1
    uhi &= (1 << 64) - 1
    shared = 64 - (ulo ^ uhi).bit_length()
    start = min(shared // digit_bits, 64 // digit_bits - 1)
    known_prefix = ulo >> (64 - start * digit_bits) if start else 0

    # target side carries its group keys under its own names (no self-join ambiguity)
    sk = [f"_k{i}" for i in range(len(g))]
    totals = counts.groupBy(*g).agg(F.sum("_c").alias("_n"))
    ps = F.array(*[F.lit(float(p)) for p in percentiles])
    state = (totals.select(*[F.col(c).alias(k) for c, k in zip(g, sk)], F.explode(ps).alias("percentile"), "_n")
             .select(*sk, "percentile",
                     F.greatest(F.lit(1), F.ceil(F.col("percentile") * F.col("_n"))).cast("bigint").alias("_r"),
                     F.lit(known_prefix).cast("bigint").alias("_prefix")))

    if salt_buckets > 0:
        counts = counts.withColumn("_salt", F.pmod(F.xxhash64("_u"), F.lit(salt_buckets)))
    mask = (1 << digit_bits) - 1
    for level in range(start, 64 // digit_bits):
        fixed = level * digit_bits
        digit = F.shiftrightunsigned(F.col("_u"), 64 - fixed - digit_bits).bitwiseAND(F.lit(mask))
        cond = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(g, sk)]
        if fixed:
            cond.append(F.shiftrightunsigned(F.col("_u"), 64 - fixed) == F.col("_prefix"))
        targets = state
        if salt_buckets > 0:
            targets = state.withColumn("_tsalt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
            cond.append(F.col("_salt") == F.col("_tsalt"))
        cand = counts.join(targets, on=cond, how="inner").select(*sk, "percentile", "_r", "_prefix", digit.alias("_d"), "_c")
        hist = cand.groupBy(*sk, "percentile", "_r", "_prefix", "_d").agg(F.sum("_c").alias("_cnt"))
        w = (Window.partitionBy(*sk, "percentile").orderBy("_d")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        hist = hist.withColumn("_cum", F.sum("_cnt").over(w))
        pick = hist.filter((F.col("_cum") >= F.col("_r")) & (F.col("_cum") - F.col("_cnt") < F.col("_r")))
        state = pick.select(
            *sk, "percentile",
            (F.col("_r") - (F.col("_cum") - F.col("_cnt"))).alias("_r"),
            F.shiftleft(F.col("_prefix"), digit_bits).bitwiseOR(F.col("_d")).alias("_prefix"))

    return state.select(*[F.col(k).alias(c) for c, k in zip(g, sk)], "percentile",
                        F.col("_prefix").bitwiseXOR(F.lit(SIGN_BIT)).alias("value"))


def percentile_columns(df: DataFrame, group_cols: Sequence[str], value_col: str,
                       percentiles: Sequence[float], names: Sequence[str], **kw) -> DataFrame:
    """One row per group with one column per percentile (pivot of :func:`exact_percentiles`)."""
    long = exact_percentiles(df, group_cols, value_col, percentiles, **kw)
    aggs = [F.max(F.when(F.col("percentile") == F.lit(float(p)), F.col("value"))).alias(n)
            for p, n in zip(percentiles, names)]
    return long.groupBy(*group_cols).agg(*aggs)
