"""Quality rules with robust multivariate outliers (minimum covariance determinant), in DataFrame operations alone.

Base statistics of each text come from array and regular expressions. The verdict on the rows that pass the base rules:
five transformed statistics (log words, mean word length, log symbol rate, log repeated lines, repeated-word share) per
language and source are held against the location and scatter of the subset of three quarters of the rows whose
covariance determinant is least. The search has three deterministic starts per group (coordinate-wise medians and
spreads with no correlation, with that of tanh scores, with that of spatial signs). From each, concentration steps keep
the three quarters that are nearest and take their mean and covariance, until the determinant falls by less than a
millionth; of the three the least determinant counts. Rows whose Mahalanobis distance passes `cutoff` are rejected.

Statistics are fixed-point integers, so sums are exact and the result does not depend on partitions. A concentration
step is one aggregate: sums per group, start and distance step (of bounded number), combined before the shuffle, of
which those up to the three-quarter mark are added; medians too come from histograms of bounded width. The parameters
of a group are one small row. A group with fewer than `min_rows` rows uses its language's parameters, and a language
with fewer rejects nothing. The scatter is regularised: every coordinate's variance has that of FLOOR added, as most
texts have no symbols, repeats or equal lines at all and their plain determinant would be 0.

Cases: null and empty texts have no words and fail the base rule; null languages and sources are groups of their own;
repeated rows count as often as they occur; extra columns are not read; long texts are read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, drop, table

DIMS = 5
UNIT = 1024  # fixed-point steps of a statistic
#: Least standard deviation of each coordinate.
FLOOR = (0.30, 0.40, 0.70, 0.50, 0.06)
#: Distance squared beyond which a row is rejected: the 0.999 quantile of chi-square with five degrees of freedom.
CUTOFF = 20.515
#: Share of rows that a concentration step keeps, and by how much their covariance falls short at five coordinates.
KEPT_SHARE, CONSISTENCY = 0.75, 1.41
#: Least share by which a step must lower the determinant to be followed by another.
FALL = 1e-6
#: How much of a start's correlations is believed, and fixed-point steps of its scores.
TRUST, SCORE = 0.9, 4096
MIN_ROWS = 30
WINDOW = 8  # two to the number of halvings in base_statistics


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    d = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("t"))
    d = d.select(
        "doc_id", "lang", "source",
        F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "").alias("w"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    d = d.select(
        "doc_id", "lang", "source", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "w",
    )
    # A window's hash is that of its halves, so each word is read twice, not once a window.
    d = d.withColumn("g", F.expr(f"case when n_words > {WINDOW} then transform(sequence(1, size(w) - 1), i -> xxhash64(w[i - 1], w[i])) else cast(array() as array<bigint>) end")).drop("w")
    for span in (2, 4):
        d = d.withColumn("g", F.expr(f"case when size(g) > {span} then transform(sequence(1, size(g) - {span}), i -> xxhash64(g[i - 1], g[i - 1 + {span}])) else g end"))
    # Only a text that has some window twice is looked at position by position.
    d = d.withColumn("g", F.expr("case when size(g) > size(array_distinct(g)) then g else cast(array() as array<bigint>) end"))
    d = d.withColumn("s", F.expr("array_sort(transform(g, (h, i) -> struct(h as h, i as i)))")).drop("g")
    d = d.withColumn("p", F.expr("array_sort(transform(filter(s, (x, k) -> (k > 0 and s[k - 1].h = x.h) or (k < size(s) - 1 and s[k + 1].h = x.h)), x -> x.i))")).drop("s")
    d = d.withColumn("n_repeat_words", F.expr(f"aggregate(transform(p, (x, k) -> case when k < size(p) - 1 then least({WINDOW}, p[k + 1] - x) else {WINDOW} end), 0L, (a, x) -> a + x)")).drop("p")
    return d.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def transformed() -> list[Column]:
    """The statistics of a row as fixed-point integers."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    x = [
        F.log1p(F.col("n_words").cast("double")),
        F.col("word_chars") / words,
        F.log1p(1000.0 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.col("n_repeat_words") / words,
    ]
    return [F.round(F.least(c, F.lit(1000.0)) * UNIT).cast("long").alias(f"x{i}") for i, c in enumerate(x)]


def _quantile(d: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """The value at a share of each group's rows; values come in bounded numbers of steps."""
    h = d.groupBy(*keys, value).count()
    w = Window.partitionBy(*keys).orderBy(value)
    h = h.withColumn("up", F.sum("count").over(w)).withColumn("all", F.sum("count").over(Window.partitionBy(*keys)))
    return h.where(F.col("up") >= F.col("all") * share).groupBy(*keys).agg(F.min(value).alias("q"))


PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
PARAMETERS = [*[f"m{i}" for i in range(DIMS)], *[f"l{i}{j}" for i, j in PAIRS]]


def _factor(p: DataFrame) -> DataFrame:
    """Lower Cholesky factor l_ij of the covariance c_ij and its determinant, row by row of the small parameter table."""
    low = []
    for i, j in PAIRS:
        rest = " - ".join([f"c{i}{j}", *[f"l{i}{k} * l{j}{k}" for k in range(j)]])
        low.append(f"sqrt(greatest({rest}, 1e-12D)) as l{i}{i}" if i == j else f"({rest}) / l{j}{j} as l{i}{j}")
    det = " * ".join(f"l{i}{i} * l{i}{i}" for i in range(DIMS))
    return p.selectExpr("grp", "start", "n", *[f"m{i}" for i in range(DIMS)], *low, f"{det} as det")


def _distance(d: DataFrame) -> DataFrame:
    """d2: squared Mahalanobis distance, by forward substitution."""
    y = ["(" + " - ".join([f"x{i} / {UNIT}D - m{i}", *[f"l{i}{k} * y{k}" for k in range(i)]]) + f") / l{i}{i} as y{i}" for i in range(DIMS)]
    return d.selectExpr("*", *y, " + ".join(f"y{i} * y{i}" for i in range(DIMS)) + " as d2").drop(*[f"y{i}" for i in range(DIMS)])


def _by_group(x: DataFrame) -> DataFrame:
    """Each row under its language and source, and under its language."""
    lang, source = (F.coalesce(F.concat(F.lit("="), c), F.lit("?")) for c in ("lang", "source"))
    return x.select(F.explode(F.array(F.concat(lang, F.lit("\u0001"), source), lang)).alias("grp"), *[f"x{i}" for i in range(DIMS)])


def starts(rows: DataFrame) -> DataFrame:
    """Three starts of each group: medians with three correlations of the robust scores."""
    tall = rows.select("grp", F.posexplode(F.array(*[f"x{i}" for i in range(DIMS)])).alias("dim", "v")).withColumn("v", F.round(F.col("v") / 16).cast("long"))
    med = cut(_quantile(tall, ["grp", "dim"], "v", 0.5), "medians")
    dev = tall.join(med, ["grp", "dim"]).select("grp", "dim", F.abs(F.col("v") - F.col("q")).alias("a"))
    mad = _quantile(dev, ["grp", "dim"], "a", 0.5).withColumnRenamed("q", "mad")
    of = lambda c, i: F.max(F.when(F.col("dim") == i, F.col(c) * 16.0 / UNIT))
    spot = med.join(mad, ["grp", "dim"]).groupBy("grp").agg(*[of("q", i).alias(f"m{i}") for i in range(DIMS)], *[of("mad", i).alias(f"s{i}") for i in range(DIMS)])
    spot = cut(spot.withColumns({f"s{i}": F.sqrt(F.pow(F.col(f"s{i}") * 1.4826, F.lit(2.0)) + FLOOR[i] ** 2) for i in range(DIMS)}), "medians")
    z = rows.join(spot, "grp").select("grp", *[((F.col(f"x{i}") / UNIT - F.col(f"m{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i in range(DIMS)])
    norm = F.sqrt(reduce(lambda a, b: a + b, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(DIMS)]))
    whole = lambda c: F.round(c * SCORE).cast("long")
    z = z.select("grp", *[whole(F.tanh(f"z{i}")).alias(f"h{i}") for i in range(DIMS)], *[whole(F.coalesce(F.col(f"z{i}") / F.nullif(norm, F.lit(0.0)), F.lit(0.0))).alias(f"u{i}") for i in range(DIMS)])
    sums = z.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"h{i}").alias(f"h{i}") for i in range(DIMS)],
        *[F.sum(F.col(f"{c}{i}") * F.col(f"{c}{j}")).cast("double").alias(f"{c}{i}{j}") for c in "hu" for i, j in PAIRS],
    )
    sums = sums.select("*", *[(F.col(f"h{i}{j}") - F.col(f"h{i}").cast("double") * F.col(f"h{j}") / F.col("n")).alias(f"v{i}{j}") for i, j in PAIRS]).join(spot, "grp")

    def start(k: int, c: str | None) -> DataFrame:
        def cov(i: int, j: int) -> Column:
            if i == j:
                return F.pow(f"s{i}", F.lit(2.0))
            if c is None:
                return F.lit(0.0)
            r = F.col(f"{c}{i}{j}") / F.nullif(F.sqrt(F.greatest(F.col(f"{c}{i}{i}") * F.col(f"{c}{j}{j}"), F.lit(0.0))), F.lit(0.0))
            return F.coalesce(r, F.lit(0.0)) * TRUST * F.col(f"s{i}") * F.col(f"s{j}")

        return sums.select("grp", F.lit(k).alias("start"), "n", *[f"m{i}" for i in range(DIMS)], *[cov(i, j).alias(f"c{i}{j}") for i, j in PAIRS])

    out = cut(_factor(start(0, None).unionByName(start(1, "v")).unionByName(start(2, "u"))).withColumns({"det": F.lit(float("inf")), "moves": F.lit(True)}), "mcd-0")
    drop(med, spot)
    return out


def step(rows: DataFrame, par: DataFrame) -> DataFrame:
    """One concentration step of every group and start of par."""
    near = _distance(rows.join(par.select("grp", "start", *PARAMETERS), "grp"))
    near = near.select("grp", "start", *[f"x{i}" for i in range(DIMS)], F.floor(64 * F.log2(1 + F.col("d2"))).cast("long").alias("bin"))
    xs = range(DIMS)
    # A product is split, so that sums of any number of rows are exact.
    parts = {"n": "count(1)"} | {f"t{i}": f"sum(x{i})" for i in xs}
    parts |= {f"high{i}{j}": f"sum(shiftright(x{i} * x{j}, 20))" for i, j in PAIRS} | {f"low{i}{j}": f"sum((x{i} * x{j}) & {(1 << 20) - 1}L)" for i, j in PAIRS}
    bins = near.groupBy("grp", "start", "bin").agg(*[F.expr(e).alias(c) for c, e in parts.items()])
    bins = bins.selectExpr("*", "sum(n) over (partition by grp, start order by bin) - n as before", "sum(n) over (partition by grp, start) as all")
    s = bins.where(f"before < all * {KEPT_SHARE}D").groupBy("grp", "start").agg(*[F.expr(f"sum({c})").alias(c) for c in parts])
    means = [f"t{i} / n / {UNIT}D as m{i}" for i in xs]
    cov = [f"((high{i}{j} * {1 << 20}D + low{i}{j}) / n / {UNIT**2}D - m{i} * m{j}) * {CONSISTENCY}D" for i, j in PAIRS]
    cov = [f"greatest({c}, 0D) + {FLOOR[i] ** 2}D as c{i}{j}" if i == j else f"{c} as c{i}{j}" for c, (i, j) in zip(cov, PAIRS)]
    return _factor(s.selectExpr("grp", "start", "n", *means, *cov))


def location_and_scatter(x: DataFrame) -> DataFrame:
    """Parameters of each group: rows of its subset, means, Cholesky factor and determinant of the scatter."""
    rows = _by_group(x)
    par = starts(rows)
    fields = ["n", "det", *PARAMETERS]
    while not par.where("moves").isEmpty():
        new = step(rows, par.where("moves")).select("grp", "start", *[F.col(c).alias(f"_{c}") for c in fields])
        both = par.join(new, ["grp", "start"], "left")
        falls = F.coalesce(F.col("_det") < F.col("det") * (1 - FALL), F.lit(False))
        nxt = cut(both.select("grp", "start", falls.alias("moves"), *[F.when(falls, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in fields]), "mcd")
        drop(par)
        par = nxt
    best = par.groupBy("grp").agg(F.min(F.struct("det", "start", "n", *PARAMETERS)).alias("b"))
    return best.select("grp", *[F.col(f"b.{c}").alias(c) for c in ["start", *fields]])


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF, min_rows: int = MIN_ROWS) -> DataFrame:
    base = base_statistics(docs)
    base = cut(base.select("*", *transformed()), "statistics")
    x = base.where("not base_failed").select("lang", "source", *[f"x{i}" for i in range(DIMS)])
    par = cut(location_and_scatter(x).where(F.col("n") >= int(min_rows * KEPT_SHARE)).select("grp", *PARAMETERS), "parameters")
    lang, source = (F.coalesce(F.concat(F.lit("="), c), F.lit("?")) for c in ("lang", "source"))
    d = base.select("*", F.concat(lang, F.lit("\u0001"), source).alias("grp"), lang.alias("wide"))
    # A row of a small group takes its language's key; which groups are small is a short list.
    big = par.select("grp", F.lit(True).alias("big"))
    d = d.join(big, "grp", "left").withColumn("grp", F.when(F.col("big"), F.col("grp")).otherwise(F.col("wide")))
    d = _distance(d.join(par, "grp", "left"))
    kept = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.round("d2", 6).alias("distance2"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
