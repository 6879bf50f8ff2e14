"""Column-level data quality profile of the loads of a table.

Exact base aggregates. The table is reduced once to counts per (load, column, value); all exact figures
(nulls, distinct values, extremes, median, most frequent value, range and pattern violations) come from
these counts. A value that a third of all rows share is one row per task in the shuffle.

Distribution changes. A classifier two-sample test: multinomial logistic regression learns to tell the
load of a row from its binned columns. Folds are cross-fitted, so discrimination (AUC of one load
against the rest, 0.5 is none) is always measured on rows the model did not see. Per column the model
is fitted without the column (the drop in AUC) and on the column alone, where the fit has a closed form.
An AUC or a drop counts as a change if it exceeds the usual one, the median over the loads, by more than its
sampling error makes likely (with two loads, 0.5 or no drop): `level` is the chance that any of the tests of a profile (loads times columns times two) finds a change where none is.

Rows with the same bins are alike to the model: the regression runs over the distinct bin combinations with
their counts per load and fold, which is the same likelihood as over all rows; no row is sampled. All models
advance together: each step is one distributed pass that leaves the gradients and likelihoods of all models,
whose number of figures follows from bins, loads and columns, not from the data. AUCs come from histograms
of the scores, one more pass. Nothing else goes to the driver, however many combinations there are.

A relative finding (nulls, top, median) must hold on both sides. The exact figure differs from the usual, the
median over the loads; and the classifier does not rule the shift out: if a share differs by d from the other loads,
the best classifier has an AUC of 0.5 + d/2 or more, so a finding falls if the AUC, its sampling error allowed for,
stays below half of that way. In small loads the error is wide and the exact figure speaks alone; in large ones the
classifier must see the shift. A change that only the classifier
sees (the shape of a column, at the same median and shares) is in the profile as `changed`. Findings about
absolute limits (range, pattern) concern values, not a change, and need the exact figure alone.

Defined results. Rows without a load are left out. A blank text is null. Figures over non-nulls are
null where there are none, and give no finding. If values tie for the most frequent, its share is the
same. With one load, or one class in a fold, nothing can be told apart and the AUC is 0.5; findings
then cannot be relative. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.common import blank_to_null, cut


@dataclass(frozen=True)
class ColumnRule:
    """How one column is profiled; limits are numbers in the column's unit (days since 1970 for dates)."""

    name: str
    kind: str  # "date", "number" or "text"
    low: float | None = None
    high: float | None = None
    max_outside: float = 1.0
    pattern: str | None = None
    max_violating: float = 1.0
    null_shift: float = 1.0
    top_shift: float = 1.0
    median_shift: float | None = None

    def value(self) -> Column:
        """The value as text, unique per distinct value."""
        return blank_to_null(F.col(self.name)) if self.kind == "text" else F.col(self.name).cast("string")

    def number(self) -> Column:
        if self.kind == "text":
            return F.lit(None).cast("double")
        return (F.unix_date(self.name) if self.kind == "date" else F.col(self.name)).cast("double")


def value_counts(df: DataFrame, load: Column, rules: list[ColumnRule]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(r.name).alias("column_name"), r.value().alias("value"), r.number().alias("number")) for r in rules])
    return df.select(load.alias("version"), F.inline(cells)).filter(F.col("version").isNotNull()).groupBy("version", "column_name", "value", "number").agg(F.count("*").alias("n"))


def base_aggregates(counts: DataFrame, rules: list[ColumnRule]) -> DataFrame:
    """One row per load and column."""
    name, n, number = F.col("column_name"), F.col("n"), F.col("number")
    filled = F.col("value").isNotNull()
    outside = reduce(lambda a, r: F.when(name == r.name, (number < r.low) | (number > r.high)).otherwise(a), [r for r in rules if r.low is not None], F.lit(False))
    violates = reduce(lambda a, r: F.when(name == r.name, ~F.col("value").rlike(r.pattern)).otherwise(a), [r for r in rules if r.pattern], F.lit(False))
    g = counts.groupBy("version", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~filled, n)), F.lit(0)).alias("n_null"),
        F.count_if(filled).alias("n_distinct"),
        F.max(F.when(filled, n)).alias("n_top"),
        F.max_by("value", F.when(filled, F.struct(n, "value"))).alias("top_value"),
        F.min("number").alias("low"),
        F.max("number").alias("high"),
        F.percentile("number", F.lit(0.5), F.when(number.isNotNull(), n).otherwise(F.lit(1))).alias("median"),
        F.coalesce(F.sum(F.when(filled & outside, n)), F.lit(0)).alias("n_outside"),
        F.coalesce(F.sum(F.when(filled & violates, n)), F.lit(0)).alias("n_violating"),
    )
    some = F.nullif(F.col("n_rows") - F.col("n_null"), F.lit(0))
    return g.withColumns({"null_share": F.col("n_null") / F.col("n_rows"), "top_share": F.col("n_top") / some, "outside_share": F.col("n_outside") / some, "violating_share": F.col("n_violating") / some})


# ---------------------------------------------------------------- classifier two-sample test


def _bins(df: DataFrame, counts: DataFrame, rules: list[ColumnRule], n_bins: int) -> list[tuple[ColumnRule, Column, int]]:
    """Per column the bin of a row as an expression and the number of bins; bin 0 is null."""
    steps = [i / n_bins for i in range(1, n_bins)]
    numeric = [r for r in rules if r.kind != "text"]
    # sketches: where exactly a bin ends does not matter
    edges = df.agg(*[F.percentile_approx(r.number(), steps, 10_000).alias(r.name) for r in numeric]).first() if numeric else {}
    texts = counts.filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.sum("n").alias("n"))
    out = []
    for r in rules:
        if r.kind == "text":
            top = [x["value"] for x in texts.filter(F.col("column_name") == r.name).orderBy(F.desc("n"), "value").limit(n_bins).collect()]
            v = r.value()
            b = F.coalesce(F.array_position(F.array(*map(F.lit, top)), v).cast("int"), F.lit(0)) if top else F.lit(0)
            b = F.when(v.isNull(), 0).otherwise(F.when(b > 0, b + 2).when(v.rlike(r.pattern) if r.pattern else F.lit(True), 1).otherwise(2))
            out.append((r, b, n_bins + 3))
        else:
            cuts = sorted({*(edges[r.name] or []), *(x for x in (r.low, r.high) if x is not None)})
            v = r.number()
            b = reduce(lambda a, c: a + F.when(v > c, 1).otherwise(0), cuts, F.lit(1))
            out.append((r, F.when(v.isNull(), 0).otherwise(b), len(cuts) + 2))
    return out


class _Fits:
    """Logistic regressions over one-hot bins, one per set of columns and fold left out, that advance together.

    The coefficients of a model are (bins of all columns, loads); those of columns it lacks stay 0. A step solves
    with the bins' co-occurrences, scaled by the share of each load: Newton's method with the Hessian of a model
    that cannot tell the loads apart. A step that lowers the likelihood is taken back and halved.
    """

    def __init__(self, sizes: list[int], loads: int, sets: list[tuple[int, ...]], folds: int, ridge: float = 1.0) -> None:
        self.offsets, self.loads, self.sets, self.folds, self.ridge = np.r_[0, np.cumsum(sizes)], loads, sets, folds, ridge
        self.width = int(self.offsets[-1])
        self.models = [(s, k) for s in sets for k in range(folds)]
        self.beta = np.zeros((len(self.models), self.width, loads))
        self.bias = np.zeros((folds, loads))

    def columns(self, s: tuple[int, ...]) -> np.ndarray:
        return np.concatenate([np.arange(self.offsets[c], self.offsets[c + 1]) for c in s])

    def scores(self, bins: np.ndarray, model: int) -> np.ndarray:
        """(rows, loads): log odds up to a constant per row."""
        s, k = self.models[model]
        return self.bias[k] + sum(self.beta[model][self.offsets[c] + bins[:, c]] for c in s)

    def probabilities(self, bins: np.ndarray, model: int) -> np.ndarray:
        e = self.scores(bins, model)
        e = np.exp(e - e.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _patterns(b: pd.DataFrame, names: list[str], folds: int, loads: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins (rows, columns), counts (rows, folds, loads))"""
    return b[names].to_numpy(np.int64), np.vstack(b["w"].to_numpy()).astype(float).reshape(-1, folds, loads)


def _summed(df: DataFrame, f, size: int) -> np.ndarray:
    """The sum over all partitions of the vectors that f makes of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for b in batches:
            if len(b):
                total += f(b).ravel()
        at = np.flatnonzero(total)
        yield pd.DataFrame({"i": at, "v": total[at]})

    got = df.mapInPandas(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[got["i"].to_numpy(np.int64)] = got["v"].to_numpy(float)
    return out


def _auc(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Area under the ROC curve from histograms of the scores (last axis); ties count one half."""
    below = np.cumsum(negative, axis=-1) - negative
    pairs = positive.sum(axis=-1) * negative.sum(axis=-1)
    return np.where(pairs > 0, ((below + negative / 2) * positive).sum(axis=-1) / np.maximum(pairs, 1), 0.5)


def two_sample_test(df: DataFrame, load: Column, record: Column, rules: list[ColumnRule], counts: DataFrame, folds: int = 2, n_bins: int = 10, steps: int = 8, grid: int = 2_000, level: float = 0.01) -> DataFrame:
    """(version, column_name, auc_full, auc_without, auc_alone, auc_error, auc_high, changed): cross-fitted discrimination of each load.

    auc_error is the standard error of an AUC where there is no difference; auc_high is the most that auc_alone
    may stand for at the level of the test.
    """
    spark = df.sparkSession
    schema = "version string, column_name string, auc_full double, auc_without double, auc_alone double, auc_error double, auc_high double, changed boolean"
    loads = sorted(r[0] for r in counts.select("version").distinct().collect())
    if len(loads) < 2:
        return spark.createDataFrame([(v, r.name, 0.5, 0.5, 0.5, None, 0.5, False) for v in loads for r in rules], schema)
    bins = _bins(df, counts, rules, n_bins)
    names, sizes, n, every = [f"b{i}" for i in range(len(bins))], [size for _, _, size in bins], len(loads), tuple(range(len(bins)))
    rows = df.select(load.alias("version"), *[b.cast("int").alias(x) for x, (_, b, _) in zip(names, bins, strict=True)], record.alias("_record")).filter(F.col("version").isNotNull())
    cell = F.pmod(F.xxhash64("_record"), F.lit(folds)).cast("int") * n + F.array_position(F.array(*map(F.lit, loads)), F.col("version")).cast("int") - 1
    counted = rows.groupBy(*names, cell.alias("cell")).agg(F.count("*").cast("double").alias("n"))
    cells = F.map_from_entries(F.collect_list(F.struct("cell", "n")))  # at most folds times loads entries
    patterns = counted.groupBy(*names).agg(cells.alias("m")).select(*names, F.transform(F.sequence(F.lit(0), F.lit(folds * n - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("w"))
    patterns = cut(patterns)
    fits = _Fits(sizes, n, [every, *[tuple(c for c in every if c != x) for x in every if len(every) > 1]], folds)
    width, models = fits.width, len(fits.models)

    # one pass: loads and bins per fold, and how often bins go together
    def moments(b: pd.DataFrame) -> np.ndarray:
        x, w = _patterns(b, names, folds, n)
        of_bin, together = np.zeros((folds, width, n)), np.zeros((folds, width, width))
        for k in range(folds):
            rows_of = w[:, k].sum(axis=1)
            for c in every:
                np.add.at(of_bin[k], fits.offsets[c] + x[:, c], w[:, k])
                for d in every:
                    np.add.at(together[k], (fits.offsets[c] + x[:, c], fits.offsets[d] + x[:, d]), rows_of)
        return np.concatenate([of_bin.ravel(), together.ravel()])

    m = _summed(patterns, moments, folds * width * (n + width))
    of_bin, together = m[: folds * width * n].reshape(folds, width, n), m[folds * width * n :].reshape(folds, width, width)
    of_load = of_bin[:, fits.offsets[0] : fits.offsets[1]].sum(axis=1)  # (folds, loads)
    trained = of_load.sum(axis=0) - of_load  # without the fold left out
    fits.bias = np.log((trained + 0.5) / (trained + 0.5).sum(axis=1, keepdims=True))
    share = np.exp(fits.bias)
    solve = []
    for s, k in fits.models:
        at = fits.columns(s)
        solve.append(np.linalg.inv((together.sum(axis=0) - together[k])[np.ix_(at, at)] + fits.ridge * np.eye(len(at))))

    def gradients(b: pd.DataFrame) -> np.ndarray:
        x, w = _patterns(b, names, folds, n)
        grad, like = np.zeros((models, width, n)), np.zeros(models)
        for j, (s, k) in enumerate(fits.models):
            mine = w.sum(axis=1) - w[:, k]
            p = fits.probabilities(x, j)
            like[j] = (mine * np.log(np.maximum(p, 1e-300))).sum()
            rest = mine - mine.sum(axis=1, keepdims=True) * p
            for c in s:
                np.add.at(grad[j], fits.offsets[c] + x[:, c], rest)
        return np.concatenate([grad.ravel(), like])

    best, kept, pace = np.full(models, -np.inf), fits.beta.copy(), np.ones(models)
    move = np.zeros_like(fits.beta)
    for _ in range(steps):
        g = _summed(patterns, gradients, models * (width * n + 1))
        grad, like = g[:-models].reshape(models, width, n), g[-models:] - fits.ridge / 2 * (fits.beta**2).sum(axis=(1, 2))
        for j, (s, k) in enumerate(fits.models):
            if like[j] < best[j]:
                pace[j] /= 2
                fits.beta[j] = kept[j] + pace[j] * move[j]
                continue
            at = fits.columns(s)
            best[j], kept[j], pace[j] = like[j], fits.beta[j], 1.0
            move[j] = 0
            move[j][at] = solve[j] @ (grad[j][at] - fits.ridge * fits.beta[j][at]) / share[k]
            fits.beta[j] = kept[j] + move[j]
    fits.beta = kept

    # one pass: histograms of the scores of the rows each model did not see
    def histograms(b: pd.DataFrame) -> np.ndarray:
        x, w = _patterns(b, names, folds, n)
        out = np.zeros((models, n, 2, grid))
        for j, (_, k) in enumerate(fits.models):
            # scores are ranked by odds over the base rate; the scale is even around 1
            odds = fits.probabilities(x, j) / share[k]
            at = np.minimum((odds / (1 + odds) * grid).astype(np.int64), grid - 1)
            for i in range(n):
                out[j, i, 0] += np.bincount(at[:, i], w[:, k, i], minlength=grid)
                out[j, i, 1] += np.bincount(at[:, i], w[:, k].sum(axis=1) - w[:, k, i], minlength=grid)
        return out

    h = _summed(patterns, histograms, models * n * 2 * grid).reshape(models, n, 2, grid)
    each = _auc(h[:, :, 0], h[:, :, 1]).reshape(len(fits.sets), folds, n)
    weight = of_load / np.maximum(of_load.sum(axis=0), 1)
    auc = (each * weight).sum(axis=1)  # (sets, loads)
    # a model of one column has a closed form: the share of each load among the rows of a bin
    alone = np.zeros((len(bins), n))
    for c in every:
        here = of_bin[:, fits.offsets[c] : fits.offsets[c + 1]]  # (folds, bins, loads)
        for k in range(folds):
            seen = here.sum(axis=0) - here[k]
            odds = (seen + share[k]) / (seen.sum(axis=1, keepdims=True) + 1) / share[k]
            order = np.argsort(odds, axis=0, kind="stable")
            for i in range(n):
                _, tied = np.unique(odds[order[:, i], i], return_inverse=True)
                pos = np.bincount(tied, here[k][order[:, i], i])
                neg = np.bincount(tied, here[k][order[:, i]].sum(axis=1)) - pos
                alone[c, i] += weight[k, i] * _auc(pos, neg)
    total, mine = of_load.sum(), of_load.sum(axis=0)
    error = np.sqrt((total + 1) / 12 / np.maximum(mine * (total - mine), 1))
    far = NormalDist().inv_cdf(1 - level / (2 * len(bins) * n))
    out = []
    for c, (rule, _, _) in enumerate(bins):
        drop = auc[0] - (auc[1 + c] if len(every) > 1 else 0.5)
        # a load out of line makes the others differ from the rest too, if less: what counts is more than the usual
        usual, usual_drop = (max(0.5, float(np.median(alone[c]))), max(0.0, float(np.median(drop)))) if n > 2 else (0.5, 0.0)
        for i, v in enumerate(loads):
            full, without = float(auc[0, i]), float(auc[0, i] - drop[i])
            # the two models err alike, so the error of a drop is at most that of two independent ones
            changed = alone[c, i] - usual > far * error[i] or drop[i] - usual_drop > far * math.sqrt(2) * error[i]
            out.append((v, rule.name, full, without, float(alone[c, i]), float(error[i]), float(alone[c, i] + far * error[i]), bool(changed)))
    return spark.createDataFrame(out, schema)


# ---------------------------------------------------------------- profile and findings


def profile_loads(df: DataFrame, load: Column, record: Column, rules: list[ColumnRule], **test: int) -> DataFrame:
    """One row per load and column: exact aggregates, their usual figures, discrimination, findings."""
    counts = cut(value_counts(df, load, rules))
    base = base_aggregates(counts, rules)
    usual = base.groupBy("column_name").agg(F.median("null_share").alias("usual_null_share"), F.median("top_share").alias("usual_top_share"), F.median("median").alias("usual_median"))
    told = two_sample_test(df, load, record, rules, counts, **test)
    # one row per load and column on every side
    out = base.join(F.broadcast(usual), "column_name").join(F.broadcast(told), ["version", "column_name"])
    name = F.col("column_name")

    def per_rule(value) -> Column:
        return reduce(lambda a, r: F.when(name == r.name, F.lit(value(r))).otherwise(a), rules, F.lit(None).cast("double"))

    seen = lambda shift: F.col("auc_high") >= 0.5 + per_rule(shift) / 4
    differs = lambda c, limit: F.abs(F.col(c) - F.col(f"usual_{c}")) > per_rule(limit)
    findings = {
        "nulls": seen(lambda r: r.null_shift) & differs("null_share", lambda r: r.null_shift),
        "top": seen(lambda r: r.top_shift) & differs("top_share", lambda r: r.top_shift),
        "median": (F.col("auc_high") >= 0.5) & differs("median", lambda r: r.median_shift),
        "range": F.col("outside_share") > per_rule(lambda r: r.max_outside),
        "pattern": F.col("violating_share") > per_rule(lambda r: r.max_violating),
    }
    return out.withColumn("findings", F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in findings.items()]), lambda x: x.isNotNull()))


def findings(profile: DataFrame) -> DataFrame:
    return profile.select("version", "column_name", F.explode("findings").alias("finding"))
