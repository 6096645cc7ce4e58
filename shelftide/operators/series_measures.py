"""Predictability measures that need the ordered values of a series, as expressions over the array layer.

A series is a row, as long as the calendar at most, so what walks along it is a fold or an array expression
inside that row and needs no shuffle. Only two measures leave it: Fourier sums are grouped sums over
(series, frequency), and sample entropy joins the templates of a series by the grid cells they lie in.

Every measure comes with a status: `short` (too few values), `gaps` (enough values, but no unbroken stretch
that is long enough, for the measures that need one), `constant` (nothing to measure) or `ok`. Measures that
need a stretch take the longest one of the series, the first of equals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

OK, SHORT, GAPS, CONSTANT = "ok", "short", "gaps", "constant"
KEYS = ("ItemLocationId", "Variant")
MEASURES = ("SpectralEntropy", "DfaSlope", "SampleEntropy", "PacfOrder", "PredictabilityBound",
            "SeasonalGain", "NaiveGain")


@dataclass(frozen=True)
class Settings:
    min_length: int = 56
    min_length_sampen: int = 112
    min_length_dfa: int = 182
    dfa_windows: tuple[int, ...] = (7, 14, 28, 56, 91)
    sampen_r: float = 0.2
    bins: int = 10
    pacf_lags: int = 28
    shuffles: int = 20
    seed: int = 7


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _slice(values: Column | str, start: Column, length: Column) -> Column:
    return F.slice(values, start, F.greatest(length, F.lit(0)))


def _log2(x: Column) -> Column:
    """x log2 x, 0 at 0."""
    return F.when(x > 0, x * F.log2(x)).otherwise(0.0)


def _stretch(values: str) -> Column:
    """Start and length of the longest run of values without a gap, in one fold."""
    start = F.struct(F.lit(0).alias("start"), F.lit(0).alias("best"), F.lit(0).alias("length"))

    def step(a: Column, i: Column) -> Column:
        run = i - a["start"] + 1
        return (F.when(F.get(values, i).isNull(), F.struct(
                    (i + 1).alias("start"), a["best"].alias("best"), a["length"].alias("length")))
                .when(run > a["length"], F.struct(
                    a["start"].alias("start"), a["start"].alias("best"), run.alias("length")))
                .otherwise(a))
    return F.aggregate(F.sequence(F.lit(0), F.size(values) - 1), start, step)


def prepared(array_layer: DataFrame) -> DataFrame:
    """V (values with gaps), Seen (those known), X (the longest stretch) and how many known values."""
    rows = array_layer.where(F.size("Values") > 0).select(
        *KEYS, F.col("Values").alias("V"), F.filter("Values", lambda v: v.isNotNull()).alias("Seen"),
        _stretch("Values").alias("run"))
    return rows.select(*KEYS, "V", "Seen", F.size("Seen").alias("n"),
                       F.slice("V", F.col("run.best") + 1, F.col("run.length")).alias("X"))


def _status(value: Column, least: int, unbroken: bool) -> Column:
    of = "X" if unbroken else "Seen"
    status = F.when(F.col("n") < least, SHORT)
    if unbroken:
        status = status.when(F.size("X") < least, GAPS)
    return status.when(F.array_min(of) == F.array_max(of), CONSTANT).when(value.isNull(), CONSTANT).otherwise(OK)


def _finished(series: DataFrame, rows: DataFrame, name: str, least: int, unbroken: bool = False) -> DataFrame:
    """The series as they were, with the measure `value` of `rows` under its name, only where its status is ok."""
    status = _status(F.col("value"), least, unbroken)
    return rows.select(*series.columns, F.when(status == OK, F.col("value")).alias(name), status.alias(f"{name}Status"))


def _autocorrelation(k: Column) -> Column:
    """Correlation of the pairs known on both ends; 0 for fewer than three or where a side does not vary."""
    length = F.size("V") - k
    both = F.filter(F.zip_with(_slice("V", k + 1, length), _slice("V", F.lit(1), length),
                               lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                    lambda p: p["a"].isNotNull() & p["b"].isNotNull())
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "a", "b", "ab", "aa", "bb")])
    s = F.aggregate(both, zero, lambda t, p: F.struct(
        (t["n"] + 1).alias("n"), (t["a"] + p["a"]).alias("a"), (t["b"] + p["b"]).alias("b"),
        (t["ab"] + p["a"] * p["b"]).alias("ab"), (t["aa"] + p["a"] * p["a"]).alias("aa"),
        (t["bb"] + p["b"] * p["b"]).alias("bb")))
    return s


def _correlation(s: Column) -> Column:
    va, vb = s["aa"] - s["a"] * s["a"] / s["n"], s["bb"] - s["b"] * s["b"] / s["n"]
    varies = (s["n"] >= 3) & (va > 1e-9 * s["aa"]) & (vb > 1e-9 * s["bb"])
    return F.when(varies, (s["ab"] - s["a"] * s["b"] / s["n"]) / F.sqrt(va * vb)).otherwise(0.0)


def pacf_order(series: DataFrame, s: Settings) -> DataFrame:
    """Largest lag whose partial autocorrelation exceeds 1.96 / sqrt(n): Durbin-Levinson as a fold over the
    lags, from the correlations of the pairs known on both ends."""
    bound = F.try_divide(F.lit(1.96), F.sqrt(F.size("Seen").cast("double")))
    rows = (
        series.withColumn("Sums", F.when(F.col("n") >= s.min_length, F.transform(
            F.sequence(F.lit(1), F.lit(s.pacf_lags)), _autocorrelation)))
        .withColumn("Rho", F.transform("Sums", _correlation)))
    start = F.struct(F.expr("cast(array() as array<double>)").alias("phi"), F.lit(1.0).alias("rest"),
                     F.lit(0).alias("order"))

    def step(a: Column, k: Column) -> Column:
        known = F.zip_with(a["phi"], F.reverse(F.slice("Rho", F.lit(1), k - 1)), lambda x, r: x * r)
        last = F.when(a["rest"] > 1e-9, (F.get("Rho", k - 1) - _sum(known)) / a["rest"]).otherwise(0.0)
        return F.struct(
            F.concat(F.zip_with(a["phi"], F.reverse(a["phi"]), lambda x, y: x - last * y), F.array(last)).alias("phi"),
            (a["rest"] * (1 - last * last)).alias("rest"),
            F.when(F.abs(last) > bound, k).otherwise(a["order"]).alias("order"))

    fold = F.aggregate(F.sequence(F.lit(1), F.lit(s.pacf_lags)), start, step, lambda a: a["order"].cast("double"))
    return _finished(series, rows.withColumn("value", F.when(F.col("Rho").isNotNull(), fold)), "PacfOrder", s.min_length)


def predictability_bound(series: DataFrame, s: Settings) -> DataFrame:
    """Upper bound of the chance to name the next state: the root of Fano's equation for the entropy rate of
    a first-order chain. Zero is a state of its own, the others are quantile bins of the positive values."""
    ordered, count = F.col("Ordered"), F.size("Ordered")

    def quantile(i: Column) -> Column:
        h = (count - 1) * i / (s.bins - 1)
        low = F.floor(h).cast("int")
        a, b = F.get(ordered, low), F.get(ordered, F.least(low + 1, count - 1))
        return F.round(a + (b - a) * (h - low), 9)  # off the last bit, so that a value meets its own edge

    def state(v: Column) -> Column:
        # Rounded like the edges: a sum may lie a last bit below the edge that it made itself.
        return F.when(v <= 0, 0).when(v > 0, 1 + F.size(F.filter("Edges", lambda e: e <= F.round(v, 9))))

    rows = (
        series.withColumn("Ordered", F.sort_array(F.filter("Seen", lambda v: v > 0)))
        .withColumn("Edges", F.when(count > 0, F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.lit(s.bins - 2)), quantile))).otherwise(F.expr("cast(array() as array<double>)")))
        .withColumn("States", F.transform("V", state)).withColumn("StateCount", F.size("Edges") + 2))
    moves = F.filter(F.zip_with(F.slice("States", F.lit(1), F.size("States") - 1),
                                F.slice("States", F.lit(2), F.size("States")), lambda a, b: a * 64 + b),
                     lambda m: m.isNotNull())
    rows = rows.withColumn("Moves", F.when((F.size("States") > 1) & (F.col("n") >= s.min_length), moves))
    # The moves that occur, in the order of the table of moves, with their start and how often they do.
    rows = rows.withColumn("Tally", F.transform(F.sort_array(F.array_distinct("Moves")), lambda m: F.struct(
        F.floor(m / 64).alias("a"), F.size(F.filter("Moves", lambda x: x == m)).cast("double").alias("c"))))

    def row(a: Column) -> Column:
        return F.transform(F.filter("Tally", lambda t: t["a"] == a), lambda t: t["c"])

    # Over the rows of the table of moves: row log2 row - sum of c log2 c, all by the number of moves.
    rate = _sum(F.transform(F.array_distinct("Tally.a"),
                            lambda a: _log2(_sum(row(a))) - _sum(F.transform(row(a), _log2))))
    rate = F.try_divide(rate, F.size("Moves"))
    rows = rows.withColumn("Rate", F.when(F.size("Moves") > 0, rate))
    states = F.col("StateCount").cast("double")

    def halve(a: Column, _: Column) -> Column:
        mid = (a["low"] + a["high"]) / 2
        left = -_log2(mid) - _log2(1 - mid) + (1 - mid) * F.log2(states - 1)
        return F.when(left > F.col("Rate"), F.struct(mid.alias("low"), a["high"].alias("high"))) \
            .otherwise(F.struct(a["low"].alias("low"), mid.alias("high")))

    root = F.aggregate(F.sequence(F.lit(1), F.lit(60)),
                       F.struct((1 / states).alias("low"), F.lit(1 - 1e-12).alias("high")), halve,
                       lambda a: (a["low"] + a["high"]) / 2)
    return _finished(series, rows.withColumn("value", F.when(F.col("Rate").isNotNull(), root)),
                     "PredictabilityBound", s.min_length)


def dfa_slope(series: DataFrame, s: Settings) -> DataFrame:
    """Slope of log fluctuation on log window of the walk over the longest stretch, linearly detrended in every
    window: the rest of a line fit in closed form, from the sums of y, y^2 and t y."""
    mean = F.try_divide(_sum(F.col("X")), F.size("X"))
    walk = F.aggregate(
        "X", F.struct(F.expr("cast(array() as array<double>)").alias("w"), F.lit(0.0).alias("at")),
        lambda a, v: F.struct(F.concat(a["w"], F.array(a["at"] + v - F.col("Mean"))).alias("w"),
                              (a["at"] + v - F.col("Mean")).alias("at")), lambda a: a["w"])
    long_enough = F.size("X") >= s.min_length_dfa
    rows = series.withColumn("Mean", mean).withColumn("W", F.when(long_enough, walk))

    def rest(size: int, block: Column) -> Column:
        y = F.slice("W", block * size + 1, F.lit(size))
        spread = size * (size * size - 1) / 12
        t_y = _sum(F.transform(y, lambda v, i: (i - (size - 1) / 2) * v))
        return _sum(F.transform(y, lambda v: v * v)) - _sum(y) * _sum(y) / size - t_y * t_y / spread

    def point(size: int) -> Column:
        blocks = F.floor(F.size("W") / size).cast("int")
        each = F.sequence(F.lit(0), F.greatest(blocks - 1, F.lit(0)))
        square = F.try_divide(_sum(F.transform(each, lambda b: rest(size, b))), blocks * size)
        return F.when((blocks > 0) & (square > 1e-12), F.struct(
            F.lit(math.log(size)).alias("x"), (F.log(square) / 2).alias("y")))

    rows = rows.withColumn("Points", F.when(long_enough, F.filter(
        F.array(*[point(size) for size in s.dfa_windows]), lambda p: p.isNotNull())))
    n, x, y = F.size("Points"), _sum(F.col("Points.x")), _sum(F.col("Points.y"))
    xx = _sum(F.transform("Points", lambda p: p["x"] * p["x"])) - x * x / n
    xy = _sum(F.transform("Points", lambda p: p["x"] * p["y"])) - x * y / n
    return _finished(series, rows.withColumn("value", F.when(n > 1, xy / xx)), "DfaSlope", s.min_length_dfa, True)


def shuffled(series: DataFrame, s: Settings) -> DataFrame:
    """The series with `Draws`, which all gains share: their known values shuffled `shuffles` times.

    A shuffle puts the known values, sorted by the digest of (seed, series, draw, place), on the known days,
    so gaps stay and every run gives the same draws.
    """
    def draw(d: Column) -> Column:
        keyed = F.transform("Seen", lambda v, i: F.struct(F.md5(F.concat_ws(
            "-", F.lit(str(s.seed)), F.col("ItemLocationId").cast("string"), d.cast("string"), i.cast("string")))
            .alias("k"), v.alias("v")))
        return F.transform(F.sort_array(keyed), lambda p: p["v"])

    return series.withColumn("Draws", F.when(
        F.col("n") >= s.min_length, F.transform(F.sequence(F.lit(1), F.lit(s.shuffles)), draw)))


def shuffle_gain(series: DataFrame, s: Settings, lag: int, name: str) -> DataFrame:
    """1 - error of the forecast by the value `lag` days ago over its median error on `shuffled` values."""
    place = F.filter(F.transform("V", lambda v, i: F.when(v.isNotNull(), i)), lambda i: i.isNotNull())
    rows = series.withColumn("Place", F.when(F.col("Draws").isNotNull(), place)).withColumn("Pairs", F.filter(
        F.transform("Place", lambda p, i: F.struct(
            i.alias("i"), (F.array_position("Place", p - lag) - 1).cast("int").alias("j"))),
        lambda q: q["j"] >= 0))

    def error(values: Column) -> Column:
        level = _sum(F.transform("Pairs", lambda q: F.get(values, q["i"])))
        off = _sum(F.transform("Pairs", lambda q: F.abs(F.get(values, q["i"]) - F.get(values, q["j"]))))
        return F.when(level > 0, off / level)

    rows = rows.withColumn(
        "Errors", F.sort_array(F.filter(F.transform("Draws", error), lambda e: e.isNotNull())))
    m = F.size("Errors")
    usual = (F.get("Errors", F.floor((m - 1) / 2).cast("int")) + F.get("Errors", F.floor(m / 2).cast("int"))) / 2
    return _finished(series, rows.withColumn("Usual", usual).withColumn(
        "value", F.when(F.col("Usual") > 0, 1 - error(F.col("Seen")) / F.col("Usual"))), name, s.min_length)


def spectral_entropy(series: DataFrame, s: Settings) -> DataFrame:
    """Keys and value: entropy of the periodogram of the longest stretch, 1 for white noise: Fourier sums over (series,
    frequency), frequencies dealt out so that few long series fill all tasks."""
    spark = series.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fit = series.where((F.size("X") >= s.min_length) & (F.array_min("X") < F.array_max("X")))
    size = F.size("X")
    level = F.try_divide(_sum(F.col("X")), size)
    points = (
        fit.select(*KEYS, size.alias("size"), F.posexplode(F.transform("X", lambda v: v - level)).alias("t", "x"))
        .repartition(parts, *KEYS, "t")
        .select("*", F.explode(F.sequence(F.lit(1), F.floor(F.col("size") / 2).cast("int"))).alias("k")))
    phase = F.col("k") * F.col("t") % F.col("size") * (2 * math.pi) / F.col("size")
    power = (
        points.groupBy(*KEYS, "size", "k")
        .agg(F.sum(F.col("x") * F.cos(phase)).alias("re"), F.sum(F.col("x") * F.sin(phase)).alias("im"))
        .withColumn("p", F.col("re") * F.col("re") + F.col("im") * F.col("im")))
    # sum of share ln share = sum of p ln p / P - ln P
    entropy = power.groupBy(*KEYS, "size").agg(
        F.sum("p").alias("P"), F.sum(F.when(F.col("p") > 0, F.col("p") * F.log("p")).otherwise(0.0)).alias("plog"))
    frequencies = F.floor(F.col("size") / 2).cast("double")
    return entropy.select(*KEYS, ((F.log("P") - F.col("plog") / F.col("P")) / F.log(frequencies)).alias("value"))


def sample_entropy(series: DataFrame, s: Settings) -> DataFrame:
    """Keys and value: -ln(A / B) over templates of two and three known values in a row; the radius follows the spread of the
    values other than zero.

    Equal templates are counted first, so a series of mostly zeros has few. Templates of a series meet only in
    neighbouring cells of a grid of the radius, by a join on (series, cell), not all with all.
    """
    other = F.filter("Seen", lambda v: v != 0)
    mean = F.try_divide(_sum(other), F.size(other))
    rows = series.where(F.col("n") >= s.min_length_sampen).withColumn("Mean", F.when(F.size(other) > 0, mean))
    radius = s.sampen_r * F.sqrt(_sum(F.transform(other, lambda v: (v - F.col("Mean")) * (v - F.col("Mean"))))
                                 / F.greatest(F.size(other), F.lit(1)))
    rows = rows.withColumn("r", F.coalesce(F.when(F.col("Mean").isNotNull(), F.round(radius, 9)), F.lit(0.0)))
    triples = F.transform(F.sequence(F.lit(0), F.size("V") - 3), lambda i: F.struct(
        F.get("V", i).alias("a"), F.get("V", i + 1).alias("b"), F.get("V", i + 2).alias("c")))
    whole = F.filter(triples, lambda t: t["a"].isNotNull() & t["b"].isNotNull() & t["c"].isNotNull())
    width = F.when(F.col("r") > 0, F.col("r")).otherwise(1.0)
    templates = (
        rows.where(F.size("V") >= 3).select(*KEYS, "r", F.inline(whole)).groupBy(*KEYS, "r", "a", "b", "c")
        .agg(F.count(F.lit(1)).alias("m"))
        .withColumns({"x": F.floor(F.col("a") / width), "y": F.floor(F.col("b") / width)}))
    around = [F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    reach = templates.select(
        *KEYS, "r", "a", "b", "c", "m", "x", "y", F.inline(F.array(*around))).select(
        *KEYS, "r", F.col("a").alias("a1"), F.col("b").alias("b1"), F.col("c").alias("c1"), F.col("m").alias("m1"),
        (F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"))
    met = reach.join(templates.drop("r"), [*KEYS, "x", "y"]).where(
        (F.abs(F.col("a") - F.col("a1")) <= F.col("r")) & (F.abs(F.col("b") - F.col("b1")) <= F.col("r")))
    third = F.abs(F.col("c") - F.col("c1")) <= F.col("r")
    weight = F.col("m") * F.col("m1")
    counts = met.groupBy(*KEYS).agg(F.sum(weight).alias("B"), F.sum(F.when(third, weight).otherwise(0)).alias("A"))
    own = templates.groupBy(*KEYS).agg(F.sum("m").alias("self"))
    a, b = F.col("A") - F.col("self"), F.col("B") - F.col("self")
    return counts.join(own, list(KEYS)).select(
        *KEYS, F.when((a > 0) & (b > 0), F.abs(F.log(a / b))).alias("value"))


#: Forecasts whose gain over shuffled values is measured, with their lag.
_GAINS = {"SeasonalGain": 7, "NaiveGain": 1}
#: Other measures made inside the row of a series.
_IN_ROW = {"DfaSlope": dfa_slope, "PacfOrder": pacf_order, "PredictabilityBound": predictability_bound}
#: Measures whose sums leave the row, with the setting of their least length and whether they need a stretch.
_APART = {"SpectralEntropy": (spectral_entropy, "min_length", True),
          "SampleEntropy": (sample_entropy, "min_length_sampen", False)}


def _measured(series: DataFrame, s: Settings, names: Sequence[str]) -> DataFrame:
    """The measures inside the row in one pass; then those apart join, which meet keys and statuses only."""
    apart = [n for n in names if n in _APART]
    rows = series.select("*", *[
        _status(F.lit(0.0), getattr(s, least), unbroken).alias(f"{n}Status")
        for n in apart for _, least, unbroken in [_APART[n]]])
    for name in names:
        if name in _IN_ROW:
            rows = _IN_ROW[name](rows, s)
    gains = [n for n in names if n in _GAINS]
    rows = shuffled(rows, s) if gains else rows
    for name in gains:
        rows = shuffle_gain(rows, s, _GAINS[name], name)
    rows = rows.drop("V", "Seen", "n", "X", "Draws")
    for name in apart:
        state = F.col(f"{name}Status")
        rows = (
            rows.join(_APART[name][0](series, s).withColumnRenamed("value", name), list(KEYS), "left")
            .withColumn(f"{name}Status", F.when((state == OK) & F.col(name).isNull(), CONSTANT).otherwise(state))
            .withColumn(name, F.when(state == OK, F.col(name))))
    return rows.select(*KEYS, *[c for n in names for c in (n, f"{n}Status")])


def measure(series: DataFrame, s: Settings, name: str) -> DataFrame:
    """One of `MEASURES` over prepared series."""
    return _measured(series, s, [name])


def array_measures(array_layer: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Value and status of every measure, one row for a series."""
    return _measured(prepared(array_layer), s, MEASURES)
