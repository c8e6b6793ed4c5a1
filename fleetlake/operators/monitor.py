"""Profile metrics, drift tests and alerts over prediction and feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.numeric import finite, instant, interval_us, micros, percent_change, rate, settle, slot_start
from fleetlake.functions.stats import chi2_pvalue, ks_pvalue
from fleetlake.operators.aggregates import custom_metrics
from fleetlake.operators.summaries import quantiles, value_cell, value_summary
from fleetlake.sinks.tables import save_scratch


def window_of(start: Column, width_us: Column | int) -> Column:
    return F.struct(instant(start).alias("start"), instant(start + width_us).alias("end")).alias("window")


def _slices(slices: list[str]) -> Column:
    """The whole table and each slice column alone, as array<struct<slice_key, slice_value>>.

    Encoded without nulls ('' for the whole table, '=' before a value), so that joins and windows
    on these columns are plain equalities and share one partitioning; `_shown` decodes them.
    """
    whole = F.struct(F.lit("").alias("slice_key"), F.lit("").alias("slice_value"))
    parts = [
        F.struct(
            F.lit(s).alias("slice_key"),
            F.coalesce(F.concat(F.lit("="), F.col(s).cast("string")), F.lit("")).alias("slice_value"),
        )
        for s in slices
    ]
    return F.array(whole, *parts)


def _shown() -> list[Column]:
    value = F.col("slice_value")
    return [
        F.nullif("slice_key", F.lit("")).alias("slice_key"),
        F.when(value != "", F.substring(value, 2, 2**31 - 1)).alias("slice_value"),
    ]


def _columns(numeric: list[str]) -> Column:
    """One struct per numeric column, to explode wide rows into (column_name, value)."""
    return F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in numeric]
    )


def profile(
    df: DataFrame,
    ts: str,
    numeric: list[str],
    categorical: list[str] | None = None,
    granularities: tuple[str, ...] = ("1 hour", "1 day"),
    slices: list[str] | None = None,
    distinct: str = "exact",
) -> DataFrame:
    """Profile metrics per (window, granularity, slice, column).

    Columns: window{start,end}, granularity, slice_key, slice_value, column_name, data_type, count,
    num_nulls, percent_null, percent_distinct, mean, stddev, min, max; the last four are null for
    categorical columns. slice_key is null for the whole table.

    The table is aggregated once, at the finest granularity and all slice values together, to
    mergeable moments. Coarser windows, slices and the unpivot by column work on that summary, so
    their fan-out multiplies a few rows per window and not the data. `distinct='exact'` counts
    distinct values in a pass of its own; 'approx' keeps a sketch in the same summary instead and
    needs no second pass, which is the choice for very large tables.
    """
    categorical = categorical or []
    slices = slices or []
    widths = {g: interval_us(g) for g in granularities}
    base = min(widths.values())
    if any(w % base for w in widths.values()):
        raise ValueError("granularities must be multiples of the finest one")
    if distinct not in ("exact", "approx"):
        raise ValueError("distinct must be 'exact' or 'approx'")
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    columns = [*numeric, *categorical]

    rows = df.where(F.col(ts).isNotNull()).withColumn("_base", slot_start(micros(F.col(ts)), base))
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        aggregates.append(F.count(c).alias(f"{c}__n"))
        if c in numeric:
            value = F.col(c).cast("double")
            aggregates += [
                F.avg(value).alias(f"{c}__mean"),
                (F.var_pop(value) * F.count(c)).alias(f"{c}__m2"),
                F.min(value).alias(f"{c}__min"),
                F.max(value).alias(f"{c}__max"),
            ]
        if distinct == "approx":
            aggregates.append(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(14)).alias(f"{c}__hll"))
    summary = rows.groupBy("_base", *slices).agg(*aggregates)

    # Spread is merged around one overall mean per column, a scalar taken from the summary itself:
    # sums of squares around zero would lose the spread of values that lie close together. Groups
    # with NaN or infinite values stay out of it, so that they spoil no other group.
    def overall(c: str) -> Column:
        mean = finite(F.col(f"{c}__mean"))
        n = F.when(mean.isNotNull(), F.col(f"{c}__n"))
        return F.coalesce(F.try_divide(F.sum(n * mean), F.sum(n)), F.lit(0.0))

    means = [overall(c).alias(c) for c in numeric]
    centre = summary.agg(F.struct(*means).alias("m")).scalar() if numeric else None

    grain = F.array(
        *[
            F.struct(F.lit(g).alias("granularity"), F.lit(w).alias("width"), slot_start(F.col("_base"), w).alias("start"))
            for g, w in widths.items()
        ]
    )
    place = ["granularity", "width", "start", "slice_key", "slice_value"]
    group = [*place, "column_name"]
    merges = [F.sum("_rows").alias("_rows")]
    for c in columns:
        n = F.col(f"{c}__n")
        merges.append(F.sum(n).alias(f"{c}__n"))
        if c in numeric:
            off = F.col(f"{c}__mean") - centre[c]
            merges += [
                F.sum(n * off).alias(f"{c}__off"),
                F.sum(F.col(f"{c}__m2") + n * off * off).alias(f"{c}__sq"),
                F.min(f"{c}__min").alias(f"{c}__min"),
                F.max(f"{c}__max").alias(f"{c}__max"),
            ]
        if distinct == "approx":
            merges.append(F.hll_sketch_estimate(F.hll_union_agg(f"{c}__hll")).alias(f"{c}__distinct"))
    merged = (
        summary.withColumn("_grain", F.explode(grain))
        .withColumn("_slice", F.explode(_slices(slices)))
        .select("_grain.*", "_slice.*", *[c for c in summary.columns if c not in ("_base", *slices)])
        .groupBy(*place)
        .agg(*merges)
    )

    def cell(c: str) -> Column:
        n, off, squares = F.col(f"{c}__n"), F.col(f"{c}__off"), F.col(f"{c}__sq")
        absent = F.lit(None).cast("double")
        stats = {"mean": absent, "stddev": absent, "min": absent, "max": absent}
        if c in numeric:
            low, high = F.col(f"{c}__min"), F.col(f"{c}__max")
            # Equal values have no spread; summation noise must not give them one.
            m2 = F.when(low == high, 0.0).otherwise(F.greatest(squares - off * F.try_divide(off, n), F.lit(0.0)))
            stats = {
                "mean": centre[c] + F.try_divide(off, n),
                "stddev": F.when(n > 1, F.sqrt(m2 / (n - 1))),
                "min": low,
                "max": high,
            }
        known = [F.col(f"{c}__distinct").alias("n_distinct")] if distinct == "approx" else []
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col("_rows").alias("rows"),
            n.alias("n"),
            *[v.alias(k) for k, v in stats.items()],
            *known,
        )

    merged = merged.select(*place, F.inline(F.array(*[cell(c) for c in columns])))

    if distinct == "exact":

        def distinct_of(names, value_type):
            cells = F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(value_type).alias("value")) for c in names]
            )
            return (
                rows.withColumn("_cell", F.explode(cells))
                .groupBy("_base", *slices, "_cell")
                .agg(F.lit(1).alias("_one"))
                .where(F.col("_cell.value").isNotNull())
                .withColumn("_grain", F.explode(grain))
                .withColumn("_slice", F.explode(_slices(slices)))
                .select("_grain.*", "_slice.*", "_cell.*")
                .groupBy(*group)
                .agg(F.count_distinct("value").alias("n_distinct"))
            )

        parts = [distinct_of(numeric, "double")] if numeric else []
        parts += [distinct_of(categorical, "string")] if categorical else []
        counts = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        merged = merged.join(counts, group, "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))

    return merged.select(
        window_of(F.col("start"), F.col("width")),
        "granularity",
        *_shown(),
        "column_name",
        "data_type",
        F.col("rows").alias("count"),
        (F.col("rows") - F.col("n")).alias("num_nulls"),
        (rate(F.col("rows") - F.col("n"), F.col("rows")) * 100).alias("percent_null"),
        (rate(F.col("n_distinct"), F.col("n")) * 100).alias("percent_distinct"),
        "mean",
        "stddev",
        "min",
        "max",
    )


def profile_report(metrics: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """Profile rows of the chosen columns, newest window first."""
    return (
        metrics.where(F.col("column_name").isin(columns))
        .orderBy(F.col("window.start").desc(), "column_name", "granularity", "slice_key", "slice_value")
        .limit(k)
    )


def change_from_baseline(metrics: DataFrame, baseline: DataFrame, numeric: list[str]) -> DataFrame:
    """Profile rows plus percent_change of their mean from the baseline table's mean.

    The baseline is reduced to one row of means, so nothing of its size is joined.
    """
    means = baseline.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in numeric])
    reference = means.select(F.explode(_columns(numeric)).alias("b")).select(
        F.col("b.column_name"), F.col("b.value").alias("baseline_mean")
    )
    return metrics.join(F.broadcast(reference), "column_name", "left").withColumn(
        "percent_change", percent_change(F.col("mean"), F.col("baseline_mean"))
    )


def change_from_previous(metrics: DataFrame) -> DataFrame:
    """Profile rows plus previous_mean and percent_change from the window before, null in the first.

    A (granularity, slice, column) has one row per window, so its partition follows the calendar.
    """
    series = Window.partitionBy("granularity", "slice_key", "slice_value", "column_name").orderBy("window.start")
    return metrics.withColumn("previous_mean", F.lag("mean").over(series)).withColumn(
        "percent_change", percent_change(F.col("mean"), F.col("previous_mean"))
    )


_TEST = ["start", "slice_key", "slice_value", "column_name"]
_NO_WINDOW = -(2**63)  # start of baseline rows; keys are never null, so no null filter sets one use of a shuffle apart


def _bits(bins: int) -> int:
    """Cells of a width that cuts values of one binary order into about `bins`; 0 for a single one."""
    return max(bins, 1).bit_length() - 1


def _projected(df: DataFrame, start: Column, numeric: list[str], slices: list[str], bins: int) -> DataFrame:
    """(start, slice columns, numbers as doubles), written once: counts and undecided cells both read it."""
    names = {c: f"_num_{c}" for c in numeric}
    rows = df.select(F.coalesce(start, F.lit(_NO_WINDOW)).alias("start"), *[F.col(c) for c in slices if c not in numeric], *[F.col(c).cast("double").alias(n) for c, n in names.items()])
    return save_scratch(rows.withColumns({c: F.col(f"_num_{c}").cast("string") for c in slices if c in numeric}), "projected")


def _summary(rows: DataFrame, numeric: list[str], slices: list[str], bins: int) -> DataFrame:
    named = rows.select("start", *slices, *[F.col(f"_num_{c}").alias(f"_num_{c}") for c in numeric])
    counts = value_summary(named, ["start"], _slices(slices), slices, [f"_num_{c}" for c in numeric], _bits(bins))
    return counts.withColumn("column_name", F.substring("column_name", 6, 2**31 - 1))


def _cells(rows: DataFrame, numeric: list[str], slices: list[str], bins: int) -> DataFrame:
    """(test keys, bin, value) of every row, slice and numeric column; nulls dropped."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_num_{c}").alias("value"), value_cell(F.col(f"_num_{c}"), _bits(bins)).alias("bin"))
            for c in numeric
        ]
    )
    wide = rows.withColumn("_slice", F.explode(_slices(slices))).withColumn("_cell", F.explode(cells))
    return wide.select("start", "_slice.*", "_cell.*").where(F.col("value").isNotNull())


def _bounded(counts: DataFrame) -> DataFrame:
    """Per test and bin (counts ref, cur): what lies below, the gap at the best bin edge, and a bound
    on the gap inside the bin.

    With gap g below a bin that holds shares r and c, the gap inside it is at most the larger of
    |g + r| and |g - c|, since both running shares only grow.
    """
    test = Window.partitionBy(*_TEST)
    lower = test.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    known = counts.select(
        *_TEST, "bin", "ref", "cur",
        F.coalesce(F.sum("ref").over(lower), F.lit(0)).alias("ref0"),
        F.coalesce(F.sum("cur").over(lower), F.lit(0)).alias("cur0"),
        F.sum("ref").over(test).alias("n_ref"),
        F.sum("cur").over(test).alias("n_cur"),
    ).where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    below = F.col("ref0") / F.col("n_ref") - F.col("cur0") / F.col("n_cur")
    above = (F.col("ref0") + F.col("ref")) / F.col("n_ref") - (F.col("cur0") + F.col("cur")) / F.col("n_cur")
    bound = F.greatest(F.abs(below + F.col("ref") / F.col("n_ref")), F.abs(below - F.col("cur") / F.col("n_cur")))
    gaps = known.withColumn("above", F.abs(above)).withColumn("bound", bound)
    return gaps.withColumn("edge", F.max("above").over(test))


def _wanted(bounded: DataFrame) -> DataFrame:
    """The bins that can still beat the best edge; all others are decided by their counts.

    There are up to tests x bins of them, far more in memory than the size of their file tells, so they
    are merged and never sent through the driver as one table.
    """
    wanted = bounded.where(F.col("bound") > F.col("edge")).select(*_TEST, "bin", "ref0", "cur0", "n_ref", "n_cur")
    return wanted.hint("merge")


def _ks_consecutive(df, ts, numeric, slices, width, bins) -> DataFrame:
    """KS statistic of every window against the calendar window before it.

    D is the largest gap between the two cumulative shares over all values. At bin edges it follows
    from counts; only bins that may hold a larger one are read again by value, summed up in value
    order and shifted by what lies below.
    """
    rows = _projected(df.where(F.col(ts).isNotNull()), slot_start(micros(F.col(ts)), width), numeric, slices, bins)
    cells = _cells(rows, numeric, slices, bins)
    zero, cell = F.lit(0).cast("bigint"), [*_TEST, "bin"]

    def sides(counted):
        n = F.col("n")
        both = F.array(
            F.struct(F.col("start").alias("start"), n.alias("cur"), zero.alias("ref")),
            F.struct((F.col("start") + width).alias("start"), zero.alias("cur"), n.alias("ref")),
        )
        return counted.withColumn("_side", F.explode(both)).drop("start", "n").select("*", "_side.*").drop("_side")

    sums = [F.sum("ref").alias("ref"), F.sum("cur").alias("cur")]
    bounded = save_scratch(_bounded(sides(_summary(rows, numeric, slices, bins)).groupBy(*cell).agg(*sums)), "bounds")
    places = ["ref0", "cur0", "n_ref", "n_cur"]
    inside = sides(cells.withColumn("n", F.lit(1).cast("bigint"))).join(_wanted(bounded), cell)
    points = inside.groupBy(*cell, "value").agg(*sums, *[F.first(c).alias(c) for c in places])
    up_to = Window.partitionBy(*cell).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ref, cur = F.col("ref0") + F.sum("ref").over(up_to), F.col("cur0") + F.sum("cur").over(up_to)
    gap = F.abs(ref / F.col("n_ref") - cur / F.col("n_cur"))
    return _largest(bounded, points.select(*_TEST, "n_ref", "n_cur", gap.alias("gap")))


def _largest(bounded: DataFrame, points: DataFrame) -> DataFrame:
    edges = bounded.select(*_TEST, "n_ref", "n_cur", F.col("above").alias("gap"))
    return (
        edges.unionByName(points)
        .groupBy(*_TEST)
        .agg(F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"), F.max("gap").alias("statistic"))
    )


def _ks_baseline(df, baseline, ts, numeric, slices, width, bins) -> DataFrame:
    """KS statistic of every window against one fixed baseline sample of the same slice.

    Bins are fixed cells of the number line, so both summaries cut values alike. Bins that counts do not decide are read by value: all windows' values and the
    baseline's are merged in value order per (slice, column, bin), and the running baseline count at
    a value is then known to every window. Between two values of a window its own share is constant
    and the baseline's only grows, so the largest gap lies at a value, just before one, or at an edge.
    """
    scope = ["slice_key", "slice_value", "column_name"]
    cell = [*scope, "bin"]
    rows = _projected(df.where(F.col(ts).isNotNull()), slot_start(micros(F.col(ts)), width), numeric, slices, bins)
    base = _projected(baseline, F.lit(None).cast("bigint"), numeric, slices, bins)
    current, fixed = (_cells(r, numeric, slices, bins) for r in (rows, base))
    zero = F.lit(0).cast("bigint")
    own = save_scratch(_summary(rows, numeric, slices, bins), "summary").withColumnRenamed("n", "cur").withColumn("ref", zero)
    tests = own.select(*_TEST).distinct()
    known = _summary(base, numeric, slices, bins).drop("start")
    reference = tests.join(known.hint("merge"), scope).select(*_TEST, "bin", zero.alias("cur"), F.col("n").alias("ref"))
    bounded = _bounded(own.unionByName(reference).groupBy(*_TEST, "bin").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")))
    bounded = save_scratch(bounded, "bounds")
    wanted = _wanted(bounded)

    place = [*_TEST, "bin"]
    places = ["ref0", "cur0", "n_ref", "n_cur"]
    chosen = current.join(wanted, place).groupBy(*place, "value").agg(F.count(F.lit(1)).alias("cur"), *[F.first(c).alias(c) for c in places])
    against = fixed.join(wanted.select(*cell).distinct().hint("merge"), cell, "left_semi").groupBy(*place, "value").agg(F.count(F.lit(1)).alias("ref"))
    merged = chosen.unionByName(against, allowMissingColumns=True).na.fill(0, ["ref", "cur"])
    up_to = Window.partitionBy(*cell).orderBy("value").rangeBetween(Window.unboundedPreceding, 0)
    at_value = Window.partitionBy(*cell, "value")
    mine = Window.partitionBy(*cell, "start").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    points = (
        merged.withColumn("ref1", F.sum("ref").over(up_to))
        .withColumn("ref_here", F.sum("ref").over(at_value))
        .where(F.col("start") != _NO_WINDOW)
        .withColumn("cur1", F.sum("cur").over(mine))
    )
    ref_at = (F.col("ref0") + F.col("ref1")) / F.col("n_ref")
    ref_before = (F.col("ref0") + F.col("ref1") - F.col("ref_here")) / F.col("n_ref")
    cur_at = (F.col("cur0") + F.col("cur1")) / F.col("n_cur")
    cur_before = (F.col("cur0") + F.col("cur1") - F.col("cur")) / F.col("n_cur")
    gap = F.greatest(F.abs(ref_at - cur_at), F.abs(ref_before - cur_before))
    return _largest(bounded, points.select(*_TEST, "n_ref", "n_cur", gap.alias("gap")))


def _category_counts(df, ts, categorical, slices, width) -> DataFrame:
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in categorical]
    )
    frame = df.withColumn("start", F.lit(0).cast("bigint")) if ts is None else df.where(F.col(ts).isNotNull()).withColumn(
        "start", slot_start(micros(F.col(ts)), width)
    )
    return (
        frame.withColumn("_slice", F.explode(_slices(slices)))
        .withColumn("_cell", F.explode(cells))
        .select("start", "_slice.*", "_cell.*")
        .where(F.col("value").isNotNull())
        .groupBy(*_TEST, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _chi2(pairs: DataFrame) -> DataFrame:
    """Chi-squared test that two samples share one distribution, from counts (value, ref, cur).

    The expected count of a cell is its category's total times its sample's share, so a category
    that one sample lacks has a finite contribution.
    """
    cells = pairs.groupBy(*_TEST, "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    totals = (
        pairs.groupBy(*_TEST)
        .agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
        .where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    )
    both = F.col("ref") + F.col("cur")
    n = F.col("n_ref") + F.col("n_cur")
    expected_ref, expected_cur = both * F.col("n_ref") / n, both * F.col("n_cur") / n
    term = F.pow(F.col("ref") - expected_ref, 2) / expected_ref + F.pow(F.col("cur") - expected_cur, 2) / expected_cur
    return (
        cells.join(totals, _TEST)
        .select(*_TEST, "n_ref", "n_cur", term.alias("term"))
        .groupBy(*_TEST)
        .agg(
            F.max("n_ref").alias("n_ref"),
            F.max("n_cur").alias("n_cur"),
            F.sum("term").alias("statistic"),
            (F.count(F.lit(1)) - 1).alias("degrees"),
        )
    )


def drift(
    df: DataFrame,
    ts: str,
    numeric: list[str],
    categorical: list[str] | None = None,
    granularity: str = "1 day",
    slices: list[str] | None = None,
    baseline: DataFrame | None = None,
    bins: int = 256,
) -> DataFrame:
    """Drift tests per (window, slice, column) against the previous window or a baseline table.

    Columns: window, granularity, slice_key, slice_value, column_name, drift_type (CONSECUTIVE or
    BASELINE), n_ref, n_cur, ks_test{statistic,pvalue} for numeric columns and
    chi_squared_test{statistic,pvalue} for categorical ones. A window without a predecessor, or
    with an empty side, has no row. Values are cut into fixed cells,
    about `bins` for each power of two; the result does not depend on it, but the largest group that is
    sorted does. The projected rows are written once and read twice: for their summary, and for the cells
    that the summary leaves open.
    """
    slices, categorical = slices or [], categorical or []
    width = interval_us(granularity)
    test = F.struct(F.col("statistic"), F.col("pvalue"))
    empty = F.lit(None).cast("struct<statistic:double,pvalue:double>")
    found = []
    if numeric:
        ks = (
            _ks_consecutive(df, ts, numeric, slices, width, bins)
            if baseline is None
            else _ks_baseline(df, baseline, ts, numeric, slices, width, bins)
        )
        ks = ks.withColumn("pvalue", ks_pvalue(F.col("statistic"), F.col("n_ref"), F.col("n_cur")))
        found.append(ks.withColumn("ks_test", test).withColumn("chi_squared_test", empty))
    if categorical:
        zero = F.lit(0).cast("bigint")
        counts = _category_counts(df, ts, categorical, slices, width)
        current = counts.select(*_TEST, "value", zero.alias("ref"), F.col("n").alias("cur"))
        if baseline is None:
            reference = counts.select(
                (F.col("start") + width).alias("start"), *_TEST[1:], "value", F.col("n").alias("ref"), zero.alias("cur")
            )
        else:
            fixed = _category_counts(baseline, None, categorical, slices, width)
            tests = counts.select(*_TEST).distinct()
            reference = tests.join(fixed.drop("start"), _TEST[1:]).select(
                *_TEST, "value", F.col("n").alias("ref"), zero.alias("cur")
            )
        chi = _chi2(current.unionByName(reference))
        chi = chi.withColumn("pvalue", chi2_pvalue(F.col("statistic"), F.col("degrees")))
        found.append(chi.withColumn("ks_test", empty).withColumn("chi_squared_test", test))
    columns = ["n_ref", "n_cur", "ks_test", "chi_squared_test"]
    rows = [f.select(*_TEST, *columns) for f in found]
    merged = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
    return merged.select(
        window_of(F.col("start"), width),
        F.lit(granularity).alias("granularity"),
        *_shown(),
        "column_name",
        F.lit("CONSECUTIVE" if baseline is None else "BASELINE").alias("drift_type"),
        *columns,
    )


def drift_report(metrics: DataFrame, k: int = 20, drift_type: str = "CONSECUTIVE") -> DataFrame:
    """Flat test results of one drift type, newest window first."""
    return (
        metrics.where(F.col("drift_type") == drift_type)
        .select(
            "window",
            "slice_key",
            "slice_value",
            "column_name",
            F.col("chi_squared_test.statistic").alias("chi2_stat"),
            F.col("chi_squared_test.pvalue").alias("chi2_pvalue"),
            F.col("ks_test.statistic").alias("ks_stat"),
            F.col("ks_test.pvalue").alias("ks_pvalue"),
        )
        .orderBy(F.col("window.start").desc(), "column_name", "slice_key", "slice_value")
        .limit(k)
    )


def retrain_triggers(metrics: DataFrame, limit: float = 0.15) -> DataFrame:
    """Drift rows with drift_score and whether it calls for retraining.

    The score is the KS statistic; for a categorical column Cramer's V, its counterpart in [0, 1].
    """
    n = F.col("n_ref") + F.col("n_cur")
    score = F.coalesce(F.col("ks_test.statistic"), F.sqrt(F.try_divide(F.col("chi_squared_test.statistic"), n)))
    return metrics.withColumn("drift_score", score).withColumn("retrain", F.col("drift_score") > limit)


def value_quantiles(df: DataFrame, ts: str, numeric: list[str], shares: dict[str, float], granularity: str = "1 day", slices: list[str] | None = None, bits: int = 8) -> DataFrame:
    """Quantiles per (window, slice, column) from summaries: each is within 2**-bits of a value of that rank."""
    width = interval_us(granularity)
    rows = df.where(F.col(ts).isNotNull()).withColumn("start", slot_start(micros(F.col(ts)), width))
    summary = value_summary(rows, ["start"], _slices(slices or []), slices or [], numeric, bits)
    found = quantiles(summary, shares, bits)
    return found.select(window_of(F.col("start"), width), *_shown(), "column_name", "n", *shares)


def windowed_metrics(
    df: DataFrame, ts: str, slices: list[str], definitions: dict[str, str], granularities: tuple[str, ...] = ("1 hour", "1 day")
) -> DataFrame:
    """Custom aggregates (SQL text) per window, granularity and slice."""
    grain = F.array(
        *[
            F.struct(
                F.lit(g).alias("granularity"),
                F.lit(interval_us(g)).alias("width"),
                slot_start(micros(F.col(ts)), interval_us(g)).alias("start"),
            )
            for g in granularities
        ]
    )
    rows = df.where(F.col(ts).isNotNull()).withColumn("_grain", F.explode(grain)).select("*", "_grain.*").drop("_grain")
    metrics = custom_metrics(rows, slices, ["granularity", "width", "start"], definitions)
    return metrics.select(
        window_of(F.col("start"), F.col("width")), "granularity", "slice_key", "slice_value", *definitions
    )


# Fixed value: the alert text.
ALERT_TEXT = "ALERT: Anomaly rate exceeds 5%!"


def alerts(metrics: DataFrame, metric: str, limit: float, text: str = ALERT_TEXT) -> DataFrame:
    """Rows that have the metric, with alert_status: the text above the limit, else OK."""
    status = F.when(F.col(metric) > limit, F.lit(text)).otherwise(F.lit("OK"))
    return metrics.where(F.col(metric).isNotNull()).withColumn("alert_status", status)


def compare_cohorts(features: DataFrame, current: Column) -> DataFrame:
    """Baseline against current: mean, stddev, peak temperature and row count.

    One scan with conditional aggregates instead of one filtered scan per cohort; both rows are
    always there, also for an empty cohort. Rows whose condition is null belong to neither.
    """

    def cohort(period: str, member: Column) -> Column:
        mean, peak = F.when(member, F.col("avg_temperature")), F.when(member, F.col("max_temperature"))
        return F.struct(
            F.lit(period).alias("period"),
            settle(F.avg(mean), 2).alias("mean_temp"),
            settle(F.stddev_samp(mean), 2).alias("stddev_temp"),
            settle(F.max(peak), 2).alias("peak_temp"),
            F.count_if(member).alias("gpu_count"),
        )

    both = F.array(cohort("baseline", ~current), cohort("current", current))
    return features.agg(both.alias("c")).select(F.inline("c"))
