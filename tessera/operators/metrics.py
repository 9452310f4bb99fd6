"""Word error rates, classification reports and averages of averages."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def steps(truth: list[str], hypothesis: list[str]) -> list[tuple[str, str]]:
    """(token, what happened) of a cheapest alignment with unit costs: cor, sub, del of true tokens, ins of others; ties prefer a substitution.

    A row of costs at a time: insertions, which depend on their left neighbour, are a running minimum.
    """
    n, m = len(truth), len(hypothesis)
    other, place = np.array(hypothesis, dtype=object), np.arange(m + 1)
    cost = np.zeros((n + 1, m + 1), np.int32)
    cost[0] = place
    for i, x in enumerate(truth, 1):
        above = cost[i - 1]
        row = np.concatenate([[i], np.minimum(above[:-1] + (other != x), above[1:] + 1)]) if m else np.array([i])
        cost[i] = np.minimum.accumulate(row - place) + place
    out, i, j = [], n, m
    while i or j:
        if i and j and cost[i, j] == cost[i - 1, j - 1] + (truth[i - 1] != hypothesis[j - 1]):
            i, j = i - 1, j - 1
            out.append((truth[i], "cor" if truth[i] == hypothesis[j] else "sub"))
        elif i and cost[i, j] == cost[i - 1, j] + 1:
            i -= 1
            out.append((truth[i], "del"))
        else:
            j -= 1
            out.append((hypothesis[j], "ins"))
    return out[::-1]


def alignment(truth: list[str], hypothesis: list[str]) -> tuple[int, int, int, int]:
    """(substitutions, deletions, insertions, hits) of a cheapest alignment."""
    n = Counter(what for _, what in steps(truth, hypothesis))
    return n["sub"], n["del"], n["ins"], n["cor"]


def _aligned(truth: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
    rows = [alignment((t or "").split(), (h or "").split()) for t, h in zip(truth, hypothesis, strict=True)]
    return pd.DataFrame(rows, columns=["substitutions", "deletions", "insertions", "hits"])


def aligned(truth: Column, hypothesis: Column) -> Column:
    return F.pandas_udf(_aligned, "substitutions long, deletions long, insertions long, hits long")(truth, hypothesis)


def with_errors(df: DataFrame, truth: str, hypothesis: str) -> DataFrame:
    """substitutions, deletions, insertions, word_num and wer for each row; an empty truth counts as one word."""
    d = df.withColumn("_a", aligned(F.col(truth), F.col(hypothesis))).select("*", "_a.substitutions", "_a.deletions", "_a.insertions").drop("_a")
    return d.withColumn("word_num", F.size(F.split(truth, " "))).withColumn("wer", (F.col("substitutions") + F.col("deletions") + F.col("insertions")) / F.greatest(F.size(F.filter(F.split(truth, " "), lambda x: x != "")), F.lit(1)))


def errors() -> Column:
    return F.col("substitutions") + F.col("deletions") + F.col("insertions")


def corpus_rate(df: DataFrame, digits: int = 2) -> DataFrame:
    """The mean of rates and the rate of sums, in percent."""
    return df.agg(F.round(F.avg("wer") * 100, digits).alias("mean_wer"), F.round(F.sum(errors()) / F.sum("word_num") * 100, digits).alias("weighted_wer"))


def rate_by(df: DataFrame, by: str, digits: int = 2) -> DataFrame:
    return df.groupBy(by).agg(F.round(F.sum(errors()) / F.sum("word_num") * 100, digits).alias("wer"), F.count("*").alias("n"))


def macro(by_group: DataFrame, value: str, digits: int = 2, limits: tuple[int, ...] = (5, 10, 20)) -> DataFrame:
    """The mean of already rounded group values, where there are several groups, and counts within limits."""
    return by_group.agg(F.when(F.count("*") > 1, F.round(F.avg(value), digits)).alias("macro"), F.count("*").alias("groups"), *[F.count_if(F.col(value) <= x).alias(f"within_{x}") for x in limits])


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts of pairs; negative truths aren't labelled."""
    return df.where(F.col(truth) >= 0).groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """precision, recall, f1 and support of each class, 0 where undefined."""
    c = confusion(df, truth, predicted)
    t = c.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"))
    p = c.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("found"))
    j = t.join(p, "label", "full").fillna(0)
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    j = j.withColumn("precision", ratio(F.col("tp"), F.col("found"))).withColumn("recall", ratio(F.col("tp"), F.col("support")))
    return j.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).select("label", "precision", "recall", "f1", "support")


def report_summary(report: DataFrame) -> DataFrame:
    """Macro and weighted averages."""
    w = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    return report.agg(*[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")], *[w(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")])


def mean_by(df: DataFrame, by: str, value: str) -> DataFrame:
    """A21."""
    return df.groupBy(by).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def macro_micro(by_group: DataFrame) -> DataFrame:
    """The mean of group means and the mean of all."""
    return by_group.agg(F.avg("mean").alias("macro"), (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("micro"))


def feature_moments(df: DataFrame, vector: str) -> DataFrame:
    """For each dimension count, sum and sum of squares in double precision."""
    return df.select(F.posexplode(vector).alias("dim", "x")).groupBy("dim").agg(F.count("x").alias("n"), F.sum(F.col("x").cast("double")).alias("total"), F.sum(F.col("x").cast("double") * F.col("x").cast("double")).alias("squares"))


# --- tallies of single tokens (A24), signals (X10, X11) ---


def token_tallies(df: DataFrame, reference: str, found: str) -> DataFrame:
    """token, cor, sub, del, ins over all rows; both columns are arrays of tokens. Counts of a batch are combined before the shuffle."""

    def run(batches):
        for b in batches:
            count: dict[tuple[str, str], int] = {}
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for step in steps(x or [], y or []):
                    count[step] = count.get(step, 0) + 1
            rows = [(*k, n) for k, n in count.items()]
            cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], ["token", "step", "n"])

    d = df.select(reference, found).mapInArrow(run, "token string, step string, n long")
    of = lambda s: F.coalesce(F.sum(F.when(F.col("step") == s, F.col("n"))), F.lit(0)).alias(s)
    return d.groupBy("token").agg(of("cor"), of("sub"), of("del"), of("ins"))


def signal_statistics(samples: Column, loud: float = 0.99, quiet: float = 0.01) -> Column:
    """Struct (rms, peak, clipped, silent) of an array of samples; shares of samples (X10 without the spectrum)."""
    n = F.greatest(F.size(samples), F.lit(1))
    share = lambda f: F.size(F.filter(samples, f)) / n
    power = F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    peak = F.coalesce(F.array_max(F.transform(samples, lambda x: F.abs(x.cast("double")))), F.lit(0.0))
    return F.struct(F.sqrt(power / n).alias("rms"), peak.alias("peak"), share(lambda x: F.abs(x) >= loud).alias("clipped"), share(lambda x: F.abs(x) < quiet).alias("silent"))


def repetition(samples: np.ndarray, rate: float, shortest: float = 20.0, longest: float = 180.0) -> tuple[float, float]:
    """(lag in seconds, correlation) at which a signal is most like itself; (0, 0) for one shorter than two of the shortest lags (X11)."""
    x = np.asarray(samples, float)
    low, high = int(shortest * rate), min(int(longest * rate), len(x) // 2)
    if high <= low:
        return 0.0, 0.0
    x = x - x.mean()
    size = 1 << (2 * len(x) - 1).bit_length()
    spectrum = np.fft.rfft(x, size)
    power = np.fft.irfft(spectrum * spectrum.conj(), size)[: high + 1]
    if power[0] <= 0:
        return 0.0, 0.0
    lag = low + int(power[low:].argmax())
    return lag / rate, float(power[lag] / power[0] * len(x) / (len(x) - lag))
