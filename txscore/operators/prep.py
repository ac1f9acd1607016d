"""Data-dependent feature preparation as fit (aggregations) + transform (projection).

Fit steps run as a handful of grouped aggregations over a *long* view
``(feature, value)`` of the training rows -- wide tables with hundreds of
columns never need one aggregate buffer per column, and map-side combining
collapses repeated values before the shuffle:

* null rates of every column in one pass,
* mode (ties -> smallest value) and exact interpolated median / quartiles
  (``exact_quantiles``: distinct values with counts, ``ordered_prefix`` for the
  cumulative count, a broadcast lookup of the target ranks -- no value list is
  ever gathered in one task),
* category frequencies: a 0/1 dummy with share p has population variance
  p(1-p), so the variance filter on one-hot columns is decided from counts and
  the wide matrix is never built,
* plug-in mutual information from (feature bin, label) counts,
* top-k by score keeping the original column order.

The fitted parameters are small (one row per feature, at most 18 surviving
values per categorical) and become literals of one generated ``select``; that
projection is the transform used by batch and streaming alike.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.operators.ordered import join_small, ordered_prefix
from txscore.session import materialize

# Fixed values of the source pipeline's preparation (thresholds and sizes).
MISSING_VALUES_THRESHOLD = 0.90   # keep a column if its null share is below this
VARIANCE_THRESHOLD = 0.05         # keep a column if its population variance is above this
BEST_K_FEATURES = 60              # top-k by mutual information
MI_BINS = 10                      # equal-width bins for numeric MI

TEMPORAL_FEATURES = ["days", "hour_sin", "hour_cos", "dow_sin", "dow_cos"]


# --- projections -------------------------------------------------------------

def temporal_columns(dt: Column) -> dict[str, Column]:
    """Elapsed days and cyclic hour / day-of-week codes of an integer second axis.

    Hour and day use floor division; day 0 is the axis origin, not a weekday.
    """
    dtd = dt.cast("double")
    hour = F.pmod(F.floor(dtd / F.lit(3600.0)), F.lit(24))
    dow = F.pmod(F.floor(dtd / F.lit(86400.0)), F.lit(7))
    two_pi = F.lit(2.0) * F.pi()
    return {
        "days": dtd / F.lit(86400.0),
        "hour": hour.cast("long"),
        "dow": dow.cast("long"),
        "hour_sin": F.sin(two_pi * hour / F.lit(24.0)),
        "hour_cos": F.cos(two_pi * hour / F.lit(24.0)),
        "dow_sin": F.sin(two_pi * dow / F.lit(7.0)),
        "dow_cos": F.cos(two_pi * dow / F.lit(7.0)),
    }


def with_temporal(df: DataFrame, dt_col: str = "dt", keep_buckets: bool = False) -> DataFrame:
    """Add the derived time columns when ``dt_col`` is present (else unchanged)."""
    if dt_col not in df.columns or "days" in df.columns:
        return df
    cols = temporal_columns(F.col(dt_col))
    if not keep_buckets:
        cols = {k: v for k, v in cols.items() if k in TEMPORAL_FEATURES}
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


def blank_to_null(c: Column) -> Column:
    """Empty or whitespace-only text becomes NULL."""
    return F.when(c.rlike(r"^\s*$"), F.lit(None).cast("string")).otherwise(c)


def soft_double(c: Column) -> Column:
    """Number if the text parses, else NULL (ANSI-safe ``try_cast``); NaN is NULL."""
    num = c.try_cast("double")
    return F.when(~F.isnan(num), num)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in any floating-point column becomes NULL: missing has one form."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.select(*[F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if c in floats else F.col(c)
                       for c in df.columns])


def canonical_code(c: Column) -> Column:
    """Category codes: integral numbers in any spelling (``13926``, ``13926.0``)
    map to one text form; other text is kept."""
    num = c.try_cast("double")
    small = num.isNotNull() & ~F.isnan(num) & (F.abs(num) < F.lit(1e15))
    whole = F.floor(F.when(small, num))
    return F.when(whole == num, whole.cast("long").cast("string")).otherwise(c)


def category(c: Column) -> Column:
    """Identity of a category value, however it was written or typed: blank text and NaN are
    NULL, integral numbers have one spelling."""
    text = c.cast("string")
    return canonical_code(F.when(F.lower(F.trim(text)) != "nan", blank_to_null(text)))


def clean(df: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str] = (),
          string_cols: Sequence[str] = ()) -> DataFrame:
    """Normalise missing values and categories, the same way for fit, batch and stream:
    categories to their identity, numerics to double or NULL, blank text to NULL."""
    out = {c: category(F.col(c)) for c in cat_cols if c in df.columns}
    out |= {c: soft_double(F.col(c)) for c in num_cols if c in df.columns}
    out |= {c: blank_to_null(F.col(c)) for c in string_cols if c in df.columns and c not in out}
    return df.select(*[out[c].alias(c) if c in out else F.col(c) for c in df.columns])


def live_columns(df: DataFrame, declared: Sequence[str]) -> list[str]:
    """The declared columns that the table has, in declared order."""
    have = set(df.columns)
    return [c for c in declared if c in have]


def clean_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[blank_to_null(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# --- long views --------------------------------------------------------------

def to_long(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = (),
            value_type: str = "double") -> DataFrame:
    """(id…, feature, value) with one row per (row, column)."""
    cast = df.select(*id_cols, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return cast.unpivot(list(id_cols), list(cols), "feature", "value")


def null_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, null_rate) for all columns in one aggregate pass; NaN counts as missing."""
    kinds = dict(df.dtypes)
    missing = {c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float")
               else F.col(c).isNull() for c in cols}
    row = df.agg(*[F.avg(missing[c].cast("double")).alias(c) for c in cols])
    return row.unpivot([], list(cols), "feature", "null_rate")


def kept_by_null_rate(rates: DataFrame, threshold: float = MISSING_VALUES_THRESHOLD) -> DataFrame:
    return rates.withColumn("kept", F.col("null_rate") < F.lit(threshold))


# --- exact statistics ----------------------------------------------------------

def exact_quantiles(long_df: DataFrame, probs: Sequence[float], group_cols: Sequence[str] = ("feature",),
                    value: str = "value", weight: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group (numpy ``linear``).

    Returns (group…, p, q). Weights are integer repeat counts.
    """
    group_cols = list(group_cols)
    w = F.col(weight) if weight else F.lit(1)
    per = (long_df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
           .groupBy(*group_cols, F.col(value).alias("_v"))
           .agg(F.sum(w).cast("long").alias("_w"))
           .where(F.col("_w") > 0))
    cum = ordered_prefix(per, group_cols, [F.col("_v").asc()], ["_w"], index_col="_i")
    totals = per.groupBy(*group_cols).agg(F.sum("_w").alias("_n"))
    pos = (F.col("_n") - 1).cast("double") * F.col("p")
    targets = (totals
               .select(*group_cols, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
               .select(*group_cols, "p", pos.alias("_pos"))
               .select(*group_cols, "p", "_pos",
                       F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))).alias("_r"))
               .withColumn("_r", F.col("_r").cast("long"))
               .dropDuplicates(group_cols + ["p", "_r"]))
    hit = join_small(cum, targets, group_cols).where(
        (F.col("cum__w") - F.col("_w") <= F.col("_r")) & (F.col("_r") < F.col("cum__w")))
    ends = hit.groupBy(*group_cols, "p").agg(
        F.min_by("_v", "_r").alias("_lo"), F.max_by("_v", "_r").alias("_hi"),
        F.first("_pos").alias("_pos"))
    frac = F.col("_pos") - F.floor("_pos")
    q = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac)
    return ends.select(*group_cols, "p", q.alias("q"))


#: Bins of an interval in one counting pass of ``rank_values``.
RANK_BINS = 1024


def rank_values(long: DataFrame, wanted: dict[str, set[int]], stats: dict[str, dict]) -> dict:
    """{(feature, rank): value}: exact order statistics (0-based ranks) of the non-missing values
    of (feature, value), without a sort or a rewrite of the table.

    Every pass counts the values of the intervals that still hold a wanted rank in at
    most ``RANK_BINS`` bins (a grouped count with map-side combine) and keeps, for each
    rank, the bin it lies in with the smallest and largest value there; a bin of one value is
    an answer. Bins are equally wide, or, where that put most values into one bin, cut at
    approximate quantiles. ``stats``: n, lo and hi by feature. What reaches the driver and the
    tasks is bins and intervals of the wanted ranks, whatever the number of rows."""
    spark, found = long.sparkSession, {}
    open_: list[tuple] = []  # (feature, lo, hi, values below lo, edges or None, ranks)
    for f, ranks in wanted.items():
        if ranks:
            open_.append((f, stats[f]["lo"], stats[f]["hi"], 0, None, sorted(ranks)))
    while open_:
        still = []
        for item in open_:
            f, lo, hi, _, _, ranks = item
            if lo == hi:
                found.update({(f, r): lo for r in ranks})
            else:
                still.append(item)
        if not still:
            break
        rows = [(f, i, float(lo), float(hi), [float(e) for e in edges] if edges else None)
                for i, (f, lo, hi, _, edges, _) in enumerate(still)]
        intervals = spark.createDataFrame(rows, "feature string, i int, lo double, hi double, edges array<double>")
        x = long.join(F.broadcast(intervals), "feature").where("value >= lo and value <= hi")
        # halves keep the width finite for any two doubles
        even = F.floor((F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * RANK_BINS)
        cut = F.size(F.filter("edges", lambda e: e < F.col("value")))
        bins = F.when(F.col("edges").isNull(), F.least(even, F.lit(RANK_BINS - 1))).otherwise(cut)
        counts: dict[int, list] = {}
        for r in x.groupBy("i", bins.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"),
                                                     F.max("value").alias("hi")).collect():
            counts.setdefault(r["i"], []).append((r["b"], r["n"], r["lo"], r["hi"]))
        open_ = []
        for i, (f, lo, hi, below, _, ranks) in enumerate(still):
            total = sum(n for _, n, _, _ in counts[i])
            for _, n, first, last in sorted(counts[i]):
                own = [r for r in ranks if below <= r < below + n]
                if own:
                    edges = None
                    if 2 * n > total and first < last:
                        part = long.where((F.col("feature") == F.lit(f)) & F.col("value").between(
                            F.lit(float(first)), F.lit(float(last))))
                        edges = sorted(set(part.approxQuantile("value", [j / 16 for j in range(1, 16)], 0.01)))
                    open_.append((f, first, last, below, edges, own))
                below += n
    return found


def numeric_summary(train: DataFrame, num_cols: Sequence[str]) -> dict[str, dict]:
    """Per numeric feature: n, n_null, exact median, and the exact quartiles of
    the median-imputed column, from counting passes (``rank_values``).

    The imputed column is the raw one with n_null copies of the median m inserted
    after the L values below m and the E values equal to m, so its rank r maps to
    raw rank r (r < L), to m (L <= r < L + E + n_null) or to raw rank r - n_null.
    """
    if not num_cols:
        return {}
    num_cols = list(num_cols)
    values = train.select(*[soft_double(F.col(c)).alias(c) for c in num_cols])
    row = values.agg(F.count(F.lit(1)).alias("_all"), *[
        g(c).alias(f"{k}{i}") for i, c in enumerate(num_cols)
        for k, g in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    stats = {c: {"n": row[f"n{i}"], "lo": row[f"lo{i}"], "hi": row[f"hi{i}"]} for i, c in enumerate(num_cols)}
    base = {c: {"n": s["n"], "n_null": row["_all"] - s["n"]} for c, s in stats.items()}
    long = values.unpivot([], num_cols, "feature", "value").where("value is not null")

    def lerp(lo_v, hi_v, pos):
        return lo_v if lo_v == hi_v else lo_v + (hi_v - lo_v) * (pos - math.floor(pos))

    med_pos = {f: (b["n"] - 1) * 0.5 for f, b in base.items() if b["n"] > 0}
    vals = rank_values(long, {f: {math.floor(p), math.ceil(p)} for f, p in med_pos.items()}, stats)
    for f, p in med_pos.items():
        base[f]["median"] = lerp(vals[(f, math.floor(p))], vals[(f, math.ceil(p))], p)
    live = list(med_pos)
    if live:
        around = values.agg(*[
            F.count(F.when(cond, 1)).alias(f"{k}{i}") for i, f in enumerate(live)
            for k, cond in (("L", F.col(f) < F.lit(base[f]["median"])),
                            ("E", F.col(f) == F.lit(base[f]["median"])))]).first()
        for i, f in enumerate(live):
            base[f] |= {"L": around[f"L{i}"], "E": around[f"E{i}"]}
    plans = {}
    for f in live:
        b = base[f]
        n_imp = b["n"] + b["n_null"]
        lo_block, hi_block = b["L"], b["L"] + b["E"] + b["n_null"]
        for p in (0.25, 0.75):
            pos = (n_imp - 1) * p
            plans[(f, p)] = (pos, [None if lo_block <= r < hi_block else (r if r < lo_block else r - b["n_null"])
                                   for r in (math.floor(pos), math.ceil(pos))])
    raw = {f: {r for (g, _), (_, rs) in plans.items() if g == f for r in rs if r is not None} for f in live}
    qv = rank_values(long, raw, stats)
    for (f, p), (pos, rs) in plans.items():
        v = [base[f]["median"] if r is None else qv[(f, r)] for r in rs]
        base[f]["q25" if p == 0.25 else "q75"] = lerp(v[0], v[1], pos)
    return base


def modes(long_df: DataFrame, group_cols: Sequence[str] = ("feature",), value: str = "value") -> DataFrame:
    """Most frequent value per group; ties -> smallest value. (group…, mode, mode_count)."""
    cnt = (long_df.where(F.col(value).isNotNull())
           .groupBy(*group_cols, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    key = F.struct((-F.col("_c")).alias("nc"), F.col("_v").alias("v"))
    return cnt.groupBy(*group_cols).agg(F.min_by("_v", key).alias("mode"),
                                        F.max("_c").alias("mode_count"))


def fill_table(train: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str],
               summary: dict | None = None) -> DataFrame:
    """(feature, role, fill_num, fill_cat): mode for categoricals, median for numerics."""
    parts = []
    if cat_cols:
        m = modes(to_long(train, cat_cols, value_type="string"))
        parts.append(m.select("feature", F.lit("cat").alias("role"),
                              F.lit(None).cast("double").alias("fill_num"),
                              F.col("mode").alias("fill_cat")))
    if num_cols:
        summary = summary if summary is not None else numeric_summary(train, num_cols)
        rows = [(f, "num", float(summary[f]["median"]), None) for f in num_cols if "median" in summary.get(f, {})]
        parts.append(train.sparkSession.createDataFrame(
            rows, "feature string, role string, fill_num double, fill_cat string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def robust_table(train: DataFrame, num_cols: Sequence[str], medians: dict[str, float] | None = None,
                 summary: dict | None = None) -> DataFrame:
    """(feature, center, q25, q75, scale) of the *median-imputed* training numerics.

    The centre is the median (copies of it cannot move it); the quartiles are
    those of the imputed column (``numeric_summary``); a zero inter-quartile
    range scales by 1. One row per feature."""
    summary = summary if summary is not None else numeric_summary(train, num_cols)
    rows = []
    for f in num_cols:
        b = summary.get(f, {})
        if "median" not in b:
            continue
        iqr = b["q75"] - b["q25"]
        rows.append((f, float(b["median"]), float(b["q25"]), float(b["q75"]), 1.0 if iqr == 0 else float(iqr)))
    return train.sparkSession.createDataFrame(
        rows, "feature string, center double, q25 double, q75 double, scale double")


def category_shares(train_imputed: DataFrame, cat_cols: Sequence[str],
                    threshold: float = VARIANCE_THRESHOLD) -> DataFrame:
    """(feature, value, n, p, variance, kept) of every category value on train.

    A one-hot column with mean p has population variance p(1-p).
    """
    n = F.col("_n").cast("double")
    long = to_long(train_imputed, cat_cols, value_type="string")
    cnt = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    tot = long.groupBy("feature").agg(F.count(F.lit(1)).alias("_n"))
    p = F.col("n").cast("double") / n
    out = join_small(cnt, tot, ["feature"]).select(
        "feature", "value", "n", p.alias("p"), (p * (F.lit(1.0) - p)).alias("variance"))
    return out.withColumn("kept", F.col("variance") > F.lit(threshold))


def numeric_variances(scaled: DataFrame, num_cols: Sequence[str],
                      threshold: float = VARIANCE_THRESHOLD) -> DataFrame:
    row = scaled.agg(*[F.var_pop(c).alias(c) for c in num_cols])
    return (row.unpivot([], list(num_cols), "feature", "variance")
            .withColumn("kept", F.col("variance") > F.lit(threshold)))


def mi_from_counts(counts: DataFrame, group_cols: Sequence[str] = ("feature",),
                   x: str = "x", y: str = "y", n: str = "n") -> DataFrame:
    """Plug-in mutual information (nats) from contingency counts (group…, x, y, n)."""
    g = list(group_cols)
    nx = counts.groupBy(*g, x).agg(F.sum(n).alias("_nx"))
    ny = counts.groupBy(*g, y).agg(F.sum(n).alias("_ny"))
    nt = counts.groupBy(*g).agg(F.sum(n).alias("_nt"))
    j = counts.join(nx, g + [x]).join(ny, g + [y]).join(nt, g)
    c, cx, cy, ct = (F.col(k).cast("double") for k in (n, "_nx", "_ny", "_nt"))
    term = F.when(c > 0, (c / ct) * F.log((c * ct) / (cx * cy))).otherwise(F.lit(0.0))
    return j.groupBy(*g).agg(F.sum(term).alias("mi"))


def numeric_bins(df: DataFrame, num_cols: Sequence[str], ranges: dict[str, tuple[float, float]],
                 bins: int = MI_BINS) -> dict[str, Column]:
    out = {}
    for c in num_cols:
        lo, hi = ranges[c]
        if hi is None or lo is None or hi == lo:
            out[c] = F.lit(0).cast("long")
        else:
            b = F.floor((F.col(c) - F.lit(float(lo))) / F.lit(float(hi - lo)) * F.lit(float(bins)))
            out[c] = F.least(b, F.lit(bins - 1)).cast("long")
    return out


def top_k(scores: DataFrame, k: int, score: str = "mi", ordinal: str = "ordinal") -> DataFrame:
    """``selected`` = among the k best scores (NaN -> 0; ties keep the later
    column). ``mi_rank`` = ascending score rank (chart order). Bounded input: one
    row per feature."""
    from pyspark.sql import Window  # local: small per-feature table only
    s = F.coalesce(F.nanvl(F.col(score), F.lit(0.0)), F.lit(0.0))
    ranked = scores.withColumn("_s", s)  # callers pass a rounded key for stable ties
    best = F.row_number().over(Window.orderBy(F.col("_s").desc(), F.col(ordinal).desc()))
    asc = F.row_number().over(Window.orderBy(F.col("_s").asc(), F.col(ordinal).asc()))
    return ranked.select("*", (best <= k).alias("selected"), asc.cast("long").alias("mi_rank")).drop("_s")


# --- fit / transform -----------------------------------------------------------

@dataclass
class PreparedModel:
    """Frozen preparation: literals for one projection."""
    cat_cols: list[str]
    num_cols: list[str]
    fills: dict[str, object]
    center: dict[str, float]
    scale: dict[str, float]
    dummies: list[tuple[str, str]]          # surviving (feature, value), in output order
    selected: list[str] = field(default_factory=list)
    string_cols: list[str] = field(default_factory=list)

    @staticmethod
    def dummy_name(feature: str, value: str) -> str:
        return f"cat__{feature}_{value}"

    @staticmethod
    def num_name(feature: str) -> str:
        return f"num__{feature}"

    def to_json(self) -> str:
        import json
        d = dict(self.__dict__)
        d["dummies"] = [list(x) for x in self.dummies]
        return json.dumps(d)

    @staticmethod
    def from_json(text: str) -> "PreparedModel":
        import json
        d = json.loads(text)
        d["dummies"] = [tuple(x) for x in d["dummies"]]
        return PreparedModel(**d)

    def save(self, spark, path: str) -> None:
        """Persist the frozen state as one JSON text row (small by construction)."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1) \
             .write.mode("overwrite").text(path)

    @staticmethod
    def load(spark, path: str) -> "PreparedModel":
        return PreparedModel.from_json(spark.read.text(path).first()["value"])

    def feature_columns(self) -> dict[str, Column]:
        """Every prepared feature (before top-k) as a Column over cleaned input."""
        cols: dict[str, Column] = {}
        for f, v in self.dummies:
            filled = F.coalesce(category(F.col(f)), F.lit(self.fills[f]))
            cols[self.dummy_name(f, v)] = F.when(filled == F.lit(v), 1.0).otherwise(0.0)
        for f in self.num_cols:
            filled = F.coalesce(soft_double(F.col(f)), F.lit(float(self.fills[f])))
            cols[self.num_name(f)] = (filled - F.lit(self.center[f])) / F.lit(self.scale[f])
        return cols

    def transform(self, df: DataFrame, keep: Sequence[str] = ("tx_id", "label")) -> DataFrame:
        df = clean_strings(with_temporal(df), [c for c in self.string_cols if c in df.columns])
        feats = self.feature_columns()
        names = self.selected or list(feats)
        return df.select(*[c for c in keep if c in df.columns],
                         *[feats[n].alias(n) for n in names])


def fit_preparation(all_rows: DataFrame, train: DataFrame, cat_cols: Sequence[str],
                    num_cols: Sequence[str], k: int = BEST_K_FEATURES, label: str = "label",
                    string_cols: Sequence[str] = (), score_function=None,
                    id_col: str = "tx_id") -> tuple[PreparedModel, dict[str, DataFrame]]:
    """Fit every preparation step. ``score_function`` ranks the features: called with (prepared
    rows, features, discrete flags, label, id column) it returns (feature, mi), as those of
    ``operators.information`` do; plug-in mutual information if not given. ``all_rows`` feeds the null-rate pruning (all
    rows, as in the source pipeline); every other statistic uses ``train``.

    Returns the frozen model and the fitted tables (DataFrames) of each step.
    """
    string_cols = list(string_cols)
    all_rows, train = with_temporal(all_rows), with_temporal(train)
    # declared columns that the table lacks are left out
    cat_cols, num_cols = live_columns(all_rows, cat_cols), live_columns(all_rows, num_cols)
    all_rows = clean(all_rows, cat_cols, num_cols, string_cols)
    train = clean(train, cat_cols, num_cols, string_cols)
    feats = list(cat_cols) + list(num_cols)
    rates = kept_by_null_rate(null_rates(all_rows, feats))
    kept = {r["feature"] for r in rates.where("kept").select("feature").collect()}
    cats = [c for c in cat_cols if c in kept]
    nums = [c for c in num_cols if c in kept]

    summary = numeric_summary(train, nums)
    fills_df = fill_table(train, cats, nums, summary=summary)
    fills = {r["feature"]: (r["fill_cat"] if r["role"] == "cat" else r["fill_num"])
             for r in fills_df.collect()}
    rob_df = robust_table(train, nums, summary=summary)
    rob = {r["feature"]: r for r in rob_df.collect()}
    center = {c: float(rob[c]["center"]) for c in nums}
    scale = {c: float(rob[c]["scale"]) for c in nums}

    imputed = train.select(label, *[F.coalesce(F.col(c).cast("string"), F.lit(fills[c])).alias(c) for c in cats],
                           *[F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c]))).alias(c) for c in nums])
    shares = category_shares(imputed, cats)
    surv = sorted(((r["feature"], r["value"]) for r in shares.where("kept").collect()),
                  key=lambda fv: (cats.index(fv[0]), fv[1]))
    scaled = imputed.select(*[((F.col(c) - F.lit(center[c])) / F.lit(scale[c])).alias(c) for c in nums])
    nvar = numeric_variances(scaled, nums)
    nkept = [r["feature"] for r in nvar.where("kept").collect()]
    nums_kept = [c for c in nums if c in nkept]

    model = PreparedModel(cats, nums_kept, fills, center, scale, surv, [], string_cols)
    order = [PreparedModel.dummy_name(f, v) for f, v in surv] + [PreparedModel.num_name(c) for c in nums_kept]
    if score_function is None:
        mi = mutual_information(imputed, model, label)
    else:
        from txscore.operators.information import discrete_flags
        ordinal = F.create_map(*[x for i, n in enumerate(order) for x in (F.lit(n), F.lit(i))])
        mi = score_function(model.transform(train, keep=(id_col, label)), order, discrete_flags(order),
                            label, id_col).select(
            "feature", ordinal[F.col("feature")].cast("long").alias("ordinal"), "mi")
    sel = top_k(mi.withColumn("mi_key", F.round("mi", 10)), k, score="mi_key").drop("mi_key")
    chosen = {r["feature"] for r in sel.where("selected").collect()}
    model.selected = [n for n in order if n in chosen]
    tables = {"null_rates": rates, "fills": fills_df, "robust": rob_df, "shares": shares,
              "numeric_variance": nvar, "mi": sel}
    return model, tables


def mutual_information(imputed: DataFrame, model: PreparedModel, label: str = "label") -> DataFrame:
    """(feature, ordinal, mi) for the surviving dummies and numerics."""
    nums = model.num_cols
    rng_row = imputed.agg(*[F.min(c).alias(f"lo_{c}") for c in nums],
                          *[F.max(c).alias(f"hi_{c}") for c in nums]).collect()[0] if nums else None
    ranges = {c: (rng_row[f"lo_{c}"], rng_row[f"hi_{c}"]) for c in nums}
    xs = {}
    for f, v in model.dummies:
        xs[PreparedModel.dummy_name(f, v)] = F.when(F.col(f) == F.lit(v), 1).otherwise(0).cast("long")
    for c, b in numeric_bins(imputed, nums, ranges).items():
        xs[PreparedModel.num_name(c)] = b
    wide = imputed.select(F.col(label).cast("long").alias("y"), *[e.alias(n) for n, e in xs.items()])
    long = wide.unpivot(["y"], list(xs), "feature", "x")
    counts = long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    mi = mi_from_counts(materialize(counts))  # small, and read four times
    ordinals = {n: i for i, n in enumerate(xs)}
    ord_map = F.create_map(*[x for n, i in ordinals.items() for x in (F.lit(n), F.lit(i))])
    return mi.select("feature", ord_map[F.col("feature")].cast("long").alias("ordinal"), "mi")

