"""Quality rules on text statistics: fixed base rules, then robust multivariate outliers per language and source.

Everything is a column expression. A text is measured within its row; the minimum-covariance-determinant estimates
come from small per-group sums, so that no group is gathered in a task, however many rows it has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import BLANK, words

SYMBOLS = "#*$%&|<>"
WINDOW, MIN_WORDS, MAX_REPEATED_PERCENT = 5, 10, 20
# Transformed statistics: base-2 logarithms in 1024ths, whole numbers so that their sums don't depend on the order.
STATS = ("word_length", "symbols", "duplicate_lines", "repeats", "capitals")
UNIT = 1024
# Least standard deviations: most texts have no symbols or repeated lines at all. One repeated line of a short text moves
# two statistics at once and is no outlier yet.
FLOORS = (0.15, 0.35, 0.6, 0.6, 0.35)
# Rows a group must have to reject any, and bins of distance per doubling.
MIN_ROWS, BINS = 20, 64


def chi_square(x: float, k: int) -> float:
    """Distribution function of chi-square with an odd number ``k`` of degrees of freedom."""
    p, term = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for j in range(3, k + 1, 2):
        p, term = p - term, term * x / j
    return p


def quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        lo, hi = ((lo + hi) / 2, hi) if chi_square((lo + hi) / 2, k) < p else (lo, (lo + hi) / 2)
    return hi


# The estimate rests on half of a group's rows, so that it holds with nearly as many of junk. Its covariance is widened
# to that of all rows of a normal group, of which the squared distance to reject beyond passes one in a million.
SHARE, TAIL = 0.5, 1e-6
CONSISTENCY = SHARE / chi_square(quantile(SHARE, len(STATS)), len(STATS) + 2)
CUTOFF = quantile(1 - TAIL, len(STATS))
# The logarithm of a determinant has to fall by this to go on.
LEAST_FALL = 1e-6


# The expressions are SQL texts: a text is one call to the session, however large the expression.
def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeated_words(found: str) -> str:
    """Words lying in windows of five that the text has twice or more; linear unless windows do repeat.

    Windows are compared by 64-bit hashes. Where one occurs again, sorting brings its places together; the words
    covered are then counted from the sorted places.
    """
    window = ", ".join(f"get(x, i + {k})" for k in range(WINDOW))
    hashes = _let(found, "x", f"if(size(x) >= {WINDOW}, transform(sequence(0, size(x) - {WINDOW}), i -> xxhash64({window})), cast(array() AS array<bigint>))")
    same = "filter(s, (x, i) -> coalesce(get(s, i - 1).v = x.v, false) OR coalesce(get(s, i + 1).v = x.v, false))"
    places = _let("array_sort(transform(h, (v, i) -> named_struct('v', v, 'i', i)))", "s", f"array_sort(transform({same}, x -> x.i))")
    covered = _let(places, "p", f"aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))), 0L, (s, x) -> s + x)")
    return _let(hashes, "h", f"if(size(array_distinct(h)) = size(h), 0L, {covered})")


def _log(x: str) -> str:
    return f"cast(round(log2({x}) * {UNIT}) AS bigint)"


def measure(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns ``keep``, then n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the statistics."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    read = docs.select(F.struct(*keep).alias("keep"), t.alias("t"), words(F.col(text).cast("string")).alias("w"), lines.alias("l"))
    symbols = " + ".join(f"(octet_length(t) - octet_length(replace(t, '{c}', '')))" for c in SYMBOLS)
    counted = read.selectExpr(
        "keep", "cast(size(w) AS bigint) AS n_words", "cast(char_length(array_join(w, '')) AS bigint) AS word_chars",
        f"cast({symbols} AS bigint) AS n_symbols", "cast(size(l) - size(array_distinct(l)) AS bigint) AS n_dup_lines",
        f"{_repeated_words('w')} AS n_repeat_words", "size(l) AS n_lines",
        "octet_length(t) - octet_length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals")
    stats = {"word_length": "(word_chars + 1) / greatest(n_words, 1)", "symbols": "1 + 16 * n_symbols / greatest(n_words, 1)",
             "duplicate_lines": "1 + 16 * n_dup_lines / greatest(n_lines, 1)", "repeats": "1 + 16 * n_repeat_words / greatest(n_words, 1)",
             "capitals": "1 + 16 * n_capitals / greatest(word_chars, 1)"}
    return counted.selectExpr("keep.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed",
                              *[f"{_log(stats[k])} AS x_{k}" for k in STATS])


X = [f"x_{k}" for k in STATS]
_PAIRS = [(i, j) for i in range(len(X)) for j in range(i + 1)]


def _with_distance(df: DataFrame) -> DataFrame:
    """Add ``d2``, the squared Mahalanobis distance to the group's mean, by forward substitution with the group's
    Cholesky factor: one column after the other."""
    for i, x in enumerate(X):
        left = f"{x} / {UNIT}D - est.m{i}" + "".join(f" - est.l{i}{j} * _y{j}" for j in range(i))
        df = df.withColumn(f"_y{i}", F.expr(f"({left}) / est.l{i}{i}"))
    return df.withColumn("d2", F.expr(" + ".join(f"_y{i} * _y{i}" for i in range(len(X)))))


def _estimates(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ") AS est"


_FIELDS = [f"m{i}" for i in range(len(X))] + [f"l{i}{j}" for i, j in _PAIRS]


_SUMS = {"n": "count(1)", **{f"s{i}": f"sum({X[i]})" for i in range(len(X))}, **{f"p{i}{j}": f"sum({X[i]} * {X[j]})" for i, j in _PAIRS}}


def _factor(df: DataFrame, keys: list[str], consistency: float) -> DataFrame:
    """Group rows with n, sums s{i} and products p{i}{j} of the chosen rows to means and Cholesky factors ``est``, and
    ``log_det``, the logarithm of the covariance's determinant."""
    means = df.selectExpr(*keys, *[f"s{i} / cast(n AS double) / {UNIT} AS m{i}" for i in range(len(X))],
                          *[f"p{i}{j} / cast(n AS double) / {UNIT * UNIT} AS q{i}{j}" for i, j in _PAIRS])
    for i, j in _PAIRS:  # row by row, so that each step is one projection over plain columns
        rest, floor = f"(q{i}{j} - m{i} * m{j})", FLOORS[i] ** 2
        rest = f"greatest({rest}, 0D) * {consistency!r}D + {floor!r}D" if i == j else f"{rest} * {consistency!r}D"
        rest += "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        means = means.withColumn(f"l{i}{j}", F.expr(f"sqrt(greatest({rest}, {floor / 4!r}D))" if i == j else f"({rest}) / l{j}{j}"))
    return means.selectExpr(*keys, _estimates({f: f for f in _FIELDS}), "2 * (" + " + ".join(f"ln(l{i}{i})" for i in range(len(X))) + ") AS log_det")


def _centres(rows: DataFrame) -> DataFrame:
    """Per group and statistic the lower quartile a{i}, the median v{i} and the upper quartile b{i}, in 64ths."""
    counts = rows.selectExpr("g", f"posexplode(array({', '.join(f'{x} div 16' for x in X)})) AS (i, v)").groupBy("g", "i", "v").agg(F.count(F.lit(1)).alias("c"))
    seen = counts.selectExpr("g", "i", "v", "sum(c) OVER (PARTITION BY g, i ORDER BY v) AS below", "sum(c) OVER (PARTITION BY g, i) AS n").where("4 * below >= n")
    quarters = {"a": 1, "v": 2, "b": 3}
    return seen.groupBy("g").agg(*[F.expr(f"min(v) FILTER (WHERE i = {i} AND 4 * below >= {q} * n) AS {c}{i}") for i in range(len(X)) for c, q in quarters.items()])


def _around_medians(deviations: list[str]) -> str:
    """Estimate at the medians with these deviations and no covariances."""
    return _estimates({f"m{i}": f"v{i} * 16 / {UNIT}D" for i in range(len(X))} | {f"l{i}{j}": deviations[i] if i == j else "0.0D" for i, j in _PAIRS})


_LEAST = [f"{f}D" for f in FLOORS]


def _starts(rows: DataFrame) -> DataFrame:
    """(g, start, est): the medians with the least deviations, the medians with those of the quartiles, all rows."""
    centres = staged(_centres(rows), "centres")
    spread = [f"sqrt(power((b{i} - a{i}) * 16 / {UNIT}D / 1.349D, 2) + {f * f!r}D)" for i, f in enumerate(FLOORS)]
    whole = _factor(rows.groupBy("g").agg(*[F.expr(f"{v} AS {k}") for k, v in _SUMS.items()]), ["g"], 1.0)
    return centres.selectExpr("g", "0 AS start", _around_medians(_LEAST)).unionByName(
        centres.selectExpr("g", "1 AS start", _around_medians(spread))).unionByName(whole.selectExpr("g", "2 AS start", "est"))


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: estimates from the share of each group's rows that lie nearest to the present ones, per start.

    Rows are summed per group and bin of distance; running sums over a group's bins, at most a few thousand, give the
    sums of its nearest rows.
    """
    keys = ["g", "start"]
    near = _with_distance(rows.join(estimates, "g")).withColumn("bin", F.expr(f"cast(floor(log2(1 + d2) * {BINS}) AS int)"))
    binned = near.groupBy(*keys, "bin").agg(*[F.expr(f"{v} AS {k}") for k, v in _SUMS.items()])
    run = binned.selectExpr(*keys, "bin", "sum(n) OVER (PARTITION BY g, start) AS everything", *[f"sum({k}) OVER (PARTITION BY g, start ORDER BY bin) AS {k}" for k in _SUMS])
    enough = run.where(f"n >= {SHARE} * everything")
    return _factor(enough.groupBy(*keys).agg(F.expr(f"min_by(struct({', '.join(_SUMS)}), bin) AS b")).select(*keys, "b.*"), keys, CONSISTENCY)


def _group(lang: str, source: str) -> Column:
    return F.struct(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(c) for c in (lang, source)])


def _large_groups(measured: DataFrame) -> DataFrame:
    """Group and statistics of the rows that pass the base rules, of groups of at least ``MIN_ROWS`` of them."""
    rows = measured.where("NOT base_failed")
    large = rows.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= MIN_ROWS).select("g")
    return rows.join(large, "g", "left_semi").select("g", *X)


def estimate(measured: DataFrame) -> DataFrame:
    """(g, est) of every large group: the estimate of least determinant. ``measured`` is a written table.

    From every start, steps go on until the determinant stops falling; the driver sees one number per round.
    """
    rows = _large_groups(measured)
    now = staged(_starts(rows).selectExpr("*", "cast('Infinity' AS double) AS log_det", "true AS falling"), "estimates")
    while not now.where("falling").isEmpty():
        after = _concentrate(rows, now.where("falling").select("g", "start", "est"))
        after = after.selectExpr("g", "start", "est AS new", "log_det AS new_det")
        fell = f"coalesce(new_det < log_det - {LEAST_FALL!r}D, false)"
        now = staged(now.join(after, ["g", "start"], "left").selectExpr(
            "g", "start", f"if({fell}, new, est) AS est", f"if({fell}, new_det, log_det) AS log_det", f"{fell} AS falling"), "estimates")
    return now.groupBy("g").agg(F.expr("min_by(est, struct(log_det, start)) AS est"))


def judge(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The columns ``keep`` and, per row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept.

    ``kept`` is false if the base rules fail or the squared distance is over ``CUTOFF``. NULL texts have no words and
    fail; NULL languages and sources are groups of their own; groups of few rows reject by the base rules alone
    (distance NULL); repeated rows count each; an empty table gives an empty result.
    """
    measured = staged(measure(docs, [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("own"), _group(lang, source).alias("g")], text), "measured")
    return _verdict(measured, estimate(measured)).select("own.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")


def _verdict(measured: DataFrame, estimates: DataFrame) -> DataFrame:
    joined = measured.join(estimates.withColumnRenamed("g", "_g"), F.col("g") == F.col("_g"), "left")
    return _with_distance(joined).withColumn("distance", F.expr("if(base_failed, NULL, d2)")).withColumn("kept", F.expr(f"NOT base_failed AND coalesce(distance, 0D) <= {CUTOFF!r}D"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows that ``judge`` keeps, with their columns unchanged, whatever their names.

    NULL, empty and short texts go; NULL languages and sources are groups of their own; repeated rows are kept or go
    together; an empty table gives an empty result.

    Rows are measured once and written beside their statistics, of which the estimates read the numbers alone: measuring
    costs far more than writing, and no text is ever shuffled.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    measured = staged(measure(docs, [row, _group(lang, source).alias("g")], text), "measured")
    return _verdict(measured, estimate(measured)).where("kept").select("own.*")
