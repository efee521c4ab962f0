"""Quality rules: plain limits, and robust multivariate outliers of a source's own statistics.

For every language and source, the minimum-covariance-determinant estimate of the transformed
statistics is found by concentration steps from several fixed starts: the coordinate-wise medians with
the spreads of the axes, with the covariance of the hyperbolic tangents of the standardised rows, and with that
of their directions alone. Each step keeps the 75 % of rows with the smallest distances and takes their
mean and covariance; of the starts the one that ends at the smallest determinant wins. A text whose
Mahalanobis distance exceeds the limit is rejected. Estimates use all rows of their group that pass the
plain limits.

Distances are counted in steps of 1/``BINS`` of their logarithm, so a group's rows are added up by step before
they are shuffled, however many there are; the step that reaches the 75 % is kept whole. Statistics are
rounded to 1e-4 and summed as integers, so that results do not depend on the order of rows. Words and
5-word windows are compared by 64-bit hashes. A language and source with fewer than ``MIN_ROWS`` rows is judged with the other small ones of
its language, else with all small ones; if those are few too, by the estimate over all rows of its
language, else over all rows, however few.

Defined results: null text has no words and fails; null language or source is a group of its own;
every row gives one row; a row's extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.registry import query
from tidemark.llm.tables import written
from tidemark.llm.text import SPACE, let, whole

MIN_ROWS = 60
SHARE = 0.75
STEPS = 6
STARTS = ("axes", "signs", "tanh")
#: Steps of the logarithm of a distance: each is 0.4 % wide.
BINS = 256
#: A table by group is sent to all tasks if it has at most so many characters, counted first; else Spark joins it as it likes.
FEW_CHARACTERS = 1 << 24
#: Smallest standard deviation of each statistic; statistics that hardly vary would else reject anything.
FLOORS = (0.25, 0.08, 0.03, 0.08, 0.08)
DIMS = len(FLOORS)
#: Makes the covariance of the inner 75 % of a normal sample in five dimensions that of all of it.
CONSISTENCY = 1.41
#: Squared distance beyond which a text is rejected: the 0.999 quantile of chi-square with five degrees of freedom.
LIMIT = 20.515
UNIT = 10_000
WINDOW = 5


def _repeat_words(hashes: Column) -> Column:
    """Words covered by 5-word windows that occur twice or more, from the hashes of the windows."""
    def repeated(order: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(order, j).h == F.get(order, k).h, F.lit(False))
        at = F.transform(F.sequence(F.lit(0), F.size(order) - 1), lambda j: F.when(same(j, j - 1) | same(j, j + 1), F.get(order, j).i))
        return F.sort_array(F.filter(at, lambda i: i.isNotNull()))

    at = let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)
    start = F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(at, start, lambda a, i: F.struct(
        i.alias("p"), (a.n + F.least(F.lit(WINDOW), i - a.p)).alias("n")), lambda a: a.n)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``keep``, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_chars."""
    t = F.col("_t")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), *[docs[c].alias(f"_{c}") for c in keep], whole(docs[text_col]).alias("_t"))
    named = ["doc_id", *[f"_{c}" for c in keep]]
    rows = rows.select(
        *named,
        F.transform(F.filter(F.split(t, f"{SPACE}+"), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("words"),
        F.length(t).cast("long").alias("n_chars"),
        F.length(F.regexp_replace(t, f"{SPACE}+", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    w = F.col("words")
    rows = rows.withColumn("n_words", F.size(w).cast("long")).withColumn("n_lines", F.size("lines").cast("long")).withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    rows = rows.withColumn("windows", F.when(F.size(w) > WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("n_repeat_words", F.when(
        F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0).cast("long")).otherwise(_repeat_words(F.col("windows"))))
    return rows.select(*named, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_chars")


def _vector() -> list[Column]:
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [F.log1p("n_words"), F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
            share("n_symbols", "n_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]


def _distance(rows: DataFrame) -> DataFrame:
    """Adds d2, the squared distance from the estimate in m0.. and c00.. of the row, by forward substitution."""
    for i in range(DIMS):
        z = F.col(f"x{i}") / UNIT - F.col(f"m{i}")
        for j in range(i):
            z = z - F.col(f"l{i}{j}") * F.col(f"z{j}")
        rows = rows.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, DIMS)), F.col("z0") * F.col("z0")))


def _names(kind: str) -> list[str]:
    return [f"{kind}{i}{j}" for i in range(DIMS) for j in range(i + 1)]


def _total(value: Column) -> Column:
    """An exact sum of integers, which does not depend on their order."""
    return F.sum(value.cast("decimal(28,0)"))


def _few(table: DataFrame) -> bool:
    """Whether a written table by group is small."""
    return (table.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0) <= FEW_CHARACTERS


def _by_group(table: DataFrame, few: bool) -> DataFrame:
    """``table`` for a join by group: broadcast if it is small, so that the rows of a hot group stay where they are."""
    return F.broadcast(table) if few else table


def _factored(rows: DataFrame, covariance) -> DataFrame:
    """Adds the Cholesky factor l00.. of ``covariance(i, j)``, whose variances get their floors added, and its log determinant."""
    for i in range(DIMS):
        for j in range(i + 1):
            left = covariance(i, j)
            if i == j:
                left = F.greatest(left, F.lit(0.0)) + FLOORS[i] ** 2
            for k in range(j):
                left = left - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            rows = rows.withColumn(f"l{i}{j}", F.sqrt(F.greatest(left, F.lit(1e-6))) if i == j else left / F.col(f"l{j}{j}"))
    return rows.withColumn("log_det", sum((2 * F.log(f"l{i}{i}") for i in range(1, DIMS)), 2 * F.log("l00")))


def _starts(clean: DataFrame) -> tuple[DataFrame, bool]:
    """g, start, centre m0.. and factor l00..: the medians with each of the covariances to start from; whether that is little."""
    centre = clean.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), *[
        F.expr(f"percentile(x{i} div 100, array(0.25D, 0.5D, 0.75D))").alias(f"p{i}") for i in range(DIMS)])
    spread = lambda p: (F.col(p)[2] - F.col(p)[0]) * 100 / UNIT / 1.349
    centre = written(centre.select("g", "rows", *[(F.col(f"p{i}")[1] * 100 / UNIT).alias(f"m{i}") for i in range(DIMS)],
                                   *[F.greatest(spread(f"p{i}"), F.lit(FLOORS[i])).alias(f"d{i}") for i in range(DIMS)]), "centres")
    z = [F.col(f"z{i}") for i in range(DIMS)]
    rows = clean.join(_by_group(centre, _few(centre)), "g").select("g", *[((F.col(f"x{i}") / UNIT - F.col(f"m{i}")) / F.col(f"d{i}")).alias(f"z{i}") for i in range(DIMS)])
    rows = rows.withColumn("length", F.sqrt(sum((v * v for v in z[1:]), z[0] * z[0])))
    shapes = {"signs": [F.when(F.col("length") > 0, v / F.col("length")).otherwise(0.0) for v in z], "tanh": [F.tanh(v) for v in z]}
    shaped = [F.struct(F.lit(name).alias("start"), *[F.round(v * UNIT).cast("long").alias(f"u{i}") for i, v in enumerate(vs)])
              for name, vs in shapes.items()]
    sums = rows.select("g", F.inline(F.array(*shaped))).groupBy("g", "start").agg(
        *[_total(F.col(f"u{i}") * F.col(f"u{j}")).cast("double").alias(f"q{i}{j}") for i in range(DIMS) for j in range(i + 1)])
    axes = centre.select("g", F.lit("axes").alias("start"), *[
        (F.col("rows") * float(UNIT * UNIT * (i == j))).alias(f"q{i}{j}") for i in range(DIMS) for j in range(i + 1)])
    shape = centre.join(sums.unionByName(axes), "g")
    start = _factored(shape, lambda i, j: F.col(f"d{i}") * F.col(f"d{j}") * F.col(f"q{i}{j}") / F.col("rows") / (UNIT * UNIT)).select(
        "g", "start", *[f"m{i}" for i in range(DIMS)], *_names("l"))
    start = written(start, "starts")
    return start, _few(start)


def _concentrated(clean: DataFrame, estimate: DataFrame, few: bool) -> DataFrame:
    """One step of every start: mean and factor of the nearest ``SHARE`` of each group's rows, and how many they are."""
    x = [F.col(f"x{i}") for i in range(DIMS)]
    near = _distance(clean.join(_by_group(estimate, few), "g")).withColumn("bin", F.floor(BINS * F.log1p("d2")))
    bins = near.groupBy("g", "start", "bin").agg(
        F.count(F.lit(1)).alias("n"), *[_total(x[i]).alias(f"s{i}") for i in range(DIMS)],
        *[_total(x[i] * x[j]).alias(f"q{i}{j}") for i in range(DIMS) for j in range(i + 1)])
    each = Window.partitionBy("g", "start")  # a few thousand bins at most
    before = F.sum("n").over(each.orderBy("bin")) - F.col("n")
    inner = bins.withColumns({"before": before, "rows": F.sum("n").over(each)}).filter(F.col("before") < SHARE * F.col("rows"))
    names = [*[f"s{i}" for i in range(DIMS)], *_names("q")]
    sums = inner.groupBy("g", "start").agg(F.sum("n").alias("n"), *[F.sum(c).cast("double").alias(c) for c in names])
    mean = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") / UNIT for i in range(DIMS)})
    return _factored(mean, lambda i, j: (F.col(f"q{i}{j}") / F.col("n") / (UNIT * UNIT) - F.col(f"m{i}") * F.col(f"m{j}")) * CONSISTENCY).select(
        "g", "start", "n", "log_det", *[f"m{i}" for i in range(DIMS)], *_names("l"))


def minimum_determinants(clean: DataFrame, steps: int = STEPS) -> DataFrame:
    """g, start, n, log_det, m0.., l00..: the estimate of smallest determinant of each group of the integer rows x0..."""
    estimate, few = _starts(clean)
    for _ in range(steps):
        estimate = written(_concentrated(clean, estimate, few), "estimate")
    best = F.min_by(F.struct(*[c for c in estimate.columns if c != "g"]), F.struct("log_det", "start"))
    return estimate.groupBy("g").agg(best.alias("best")).select("g", "best.*")


def _groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """The group ``g`` that judges each language and source, and the groups that its rows inform.

    Its own, or that of the small ones of its language, or of all small ones; if those are few too, all rows
    of its language, or all rows.
    """
    counts = rows.filter("NOT base_failed").groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("n"))
    by_lang = counts.groupBy(F.col("_lang").alias("_l")).agg(
        F.sum("n").alias("in_lang"), F.coalesce(F.sum(F.when(F.col("n") < min_rows, F.col("n"))), F.lit(0)).alias("small_in_lang"))
    few = F.col("small_in_lang").between(1, min_rows - 1)
    rest, any_few = by_lang.agg(F.sum(F.when(few, F.col("small_in_lang"))), F.max(few & (F.col("in_lang") < min_rows))).first()  # one row
    few = few & F.lit((rest or 0) < min_rows)
    lang = F.to_json(F.struct("_lang"))
    wide = F.when(few & (F.col("in_lang") >= min_rows), F.concat(F.lit("whole language "), lang))
    close = (F.when(F.col("n") >= min_rows, F.concat(F.lit("source "), F.to_json(F.struct("_lang", "_source"))))
             .when(F.col("small_in_lang") >= min_rows, F.concat(F.lit("language "), lang))
             .when(F.lit((rest or 0) >= min_rows), F.lit("rest")))
    every = F.when(F.lit(bool(any_few) and (rest or 0) < min_rows), F.lit("all"))
    counts = counts.join(by_lang, F.col("_lang").eqNullSafe(F.col("_l")))
    return counts.select("_lang", "_source", F.coalesce(close, wide, every).alias("g"),
                         F.array_compact(F.array(close, wide, every)).alias("informs"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          limit: float = LIMIT, min_rows: int = MIN_ROWS) -> DataFrame:
    """Statistics, base_failed, the squared distance ``d2`` (null only where every row of the language and source fails) and ``kept``."""
    rows = docs.withColumns({"lang": docs[lang_col], "source": docs[source_col]})
    rows = text_statistics(rows, id_col, text_col, keep=("lang", "source"))
    rows = rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    rows = rows.withColumns({f"x{i}": F.round(v * UNIT).cast("long") for i, v in enumerate(_vector())})
    rows = written(rows, "statistics")
    groups = written(_groups(rows, min_rows), "groups")
    names = groups.select(F.col("_lang").alias("_l"), F.col("_source").alias("_s"), "g", "informs")
    rows = written(rows.join(_by_group(names, _few(groups)), F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left")
                   .drop("_l", "_s"), "grouped")
    clean = rows.filter("NOT base_failed").select(F.explode("informs").alias("g"), *[f"x{i}" for i in range(DIMS)])
    estimate = written(minimum_determinants(clean), "estimate").drop("start", "n", "log_det")
    judged = _distance(rows.join(_by_group(estimate, _few(estimate)), "g", "left"))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= limit)
    return judged.withColumn("kept", kept)


@query("op4_quality_rules")
def quality_rules(documents: DataFrame) -> DataFrame:
    return judge(documents).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                   "base_failed", "kept")
