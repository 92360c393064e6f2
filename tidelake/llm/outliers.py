"""Quality rules (method: robust multivariate outliers by minimum covariance determinant).

DataFrame functions only. Statistics of whole texts are computed in the scan; estimates are
made per group from sums, so no group is ever held in one place, and a group with a third of
all rows costs no more than its share of the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.names import own_names
from tidelake.operators.skew import broadcast_checked, lookup_join
from tidelake.session import materialize

BLANK = r"\x20\x09-\x0D"
TRIM = " \t\n\x0b\f\r"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Transformed statistics are kept as thousandths, so that sums over them are exact and
# independent of the order of rows and partitions.
SCALE = 1000
# Smallest spread taken for each, in the transformed unit: most texts have no symbol or
# repeated line at all, which must not make the first one an outlier.
FLOORS = (0.7, 0.25, 0.8, 0.8, 1.0)
CORE = 0.75             # share of a group whose covariance determinant is made small
STEPS = 3               # concentration steps
LEAST_ROWS = 100        # smaller groups are judged by the estimate over all rows
CUTOFF = 20.52          # squared distance; 5 degrees of freedom leave one in a thousand above
MEDIAN_5 = 4.351        # median of that distribution
_FINE = 32              # quantised squared distances per factor e
BROADCAST_GROUPS = 100_000      # estimates of so many groups are broadcast, some 200 bytes each


def text_statistics(text: str) -> list[tuple[str, Column]]:
    """Columns to be added one after the other (the last five are :data:`STATISTICS`).

    Windows of three words are found twice or more by sorting one bigint per window, the
    upper bits of its XXH64 with its position in the lower ones; neighbours that agree in
    the upper bits are compared word by word. A text of n words sorts n numbers.
    """
    col = F.coalesce(F.col(text), F.lit(""))
    solid = F.btrim(col, F.lit(TRIM))
    words, m, size = F.col("_words"), F.col("_mask"), F.size("_words")

    def window(i: Column) -> Column:
        mixed = F.xxhash64(words[i], words[i + 1], words[i + 2])
        return mixed.bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("long"))

    def same(a: Column, b: Column) -> Column:
        i, j = a.bitwiseAND(m).cast("int"), b.bitwiseAND(m).cast("int")
        alike = a.bitwiseXOR(b).bitwiseAND(F.bitwise_not(m)) == 0
        for k in range(3):
            alike = alike & (words[i + k] == words[j + k])
        return F.when(alike, F.array(i, j))

    ordered, places, lines = F.col("_ordered"), F.col("_places"), F.col("_lines")
    shifted = [
        lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))),
        lambda a: F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0))),
    ]
    none = F.array().cast("array<int>")
    return [
        ("_words", F.when(solid == "", F.array().cast("array<string>"))
            .otherwise(F.split(solid, f"[{BLANK}]+"))),
        ("_mask", F.expr("shiftleft(1L, length(bin(CAST(size(_words) AS BIGINT)))) - 1L")),
        ("_ordered", F.when(size >= 3, F.sort_array(F.transform(
            F.sequence(F.lit(0), F.greatest(size - 3, F.lit(0))), window)))
            .otherwise(F.array().cast("array<bigint>"))),
        ("_places", F.when(F.size(ordered) < 2, none).otherwise(F.sort_array(F.array_distinct(F.flatten(
            F.filter(F.zip_with(*[f(ordered) for f in shifted], same), lambda x: x.isNotNull())))))),
        ("_lines", F.filter(F.split(col, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))),
        ("n_words", size.cast("long")),
        ("word_chars", (F.length(col) - F.regexp_count(col, F.lit(f"[{BLANK}]"))).cast("long")),
        ("n_symbols", F.regexp_count(col, F.lit("[#*$%&|<>]")).cast("long")),
        ("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")),
        ("n_repeat_words", F.when(F.size(places) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(
            F.zip_with(*[f(places) for f in shifted], lambda a, b: F.least(b - a, F.lit(3))),
            F.lit(3).cast("long"), lambda s, x: s + x))),
    ]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the struct ``_stats`` of :data:`STATISTICS`; no shuffle."""
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    for name, value in text_statistics(f"_row.{text}"):
        work = work.withColumn(name, value)
    return work.select("_row.*", F.struct(*STATISTICS).alias("_stats"))


def _transformed() -> list[Column]:
    n, chars, symbols, dup, repeat = (F.col(f"_stats.{s}").cast("double") for s in STATISTICS)
    some = F.greatest(n, F.lit(1.0))
    values = [
        F.log1p(n), F.log1p(chars / some), F.log1p(symbols * 100 / some),
        F.log1p(dup), F.log1p(repeat * 100 / some),
    ]
    return [F.round(v * SCALE).cast("long") for v in values]


def _group(lang: str, source: str) -> Column:
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (lang, source)]
    return F.concat(parts[0], F.lit("\u0000"), parts[1])


def _inverse_root(params: DataFrame, d: int) -> DataFrame:
    """Adds m_ij (i >= j), the inverse of the Cholesky factor of the covariances s_ij, so that
    the squared distance is the plain sum of squares of m (x - centre)."""
    for i in range(d):
        for j in range(i + 1):
            rest = F.col(f"s_{i}{j}") - sum(
                (F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}") for k in range(j)), F.lit(0.0))
            value = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}{j}")
            params = params.withColumn(f"l_{i}{j}", value)
    for i in range(d):
        for j in range(i + 1):
            if i == j:
                value = 1 / F.col(f"l_{i}{i}")
            else:
                value = -sum(
                    (F.col(f"l_{i}{k}") * F.col(f"m_{k}{j}") for k in range(j, i)), F.lit(0.0)
                ) / F.col(f"l_{i}{i}")
            params = params.withColumn(f"m_{i}{j}", value)
    return params.select(
        "g", "_n", *[f"c_{i}" for i in range(d)], *[f"m_{i}{j}" for i in range(d) for j in range(i + 1)])


def _distance(d: int) -> Column:
    """Squared Mahalanobis distance of x_i, with the parameters in the same row."""
    return sum(
        (F.pow(sum((F.col(f"m_{i}{j}") * (F.col(f"x_{j}") / SCALE - F.col(f"c_{j}"))
                    for j in range(i + 1)), F.lit(0.0)), 2) for i in range(d)), F.lit(0.0))


def _with(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with the row of ``table`` (stored; g, ..., _n) for their group. Rows are not
    shuffled unless there are very many groups, and then not those of large groups."""
    return lookup_join(rows, table, ["g"], "_n", BROADCAST_GROUPS)


def estimates(rows: DataFrame) -> DataFrame:
    """Per group g of ``rows`` (g, x_0 ... x_4 in thousandths): centre c_i, m_ij as above and
    ``scale``, by which squared distances are divided to have the expected median.

    Starts from medians and median deviations, then ``STEPS`` times takes the ``CORE`` share
    of nearest rows and their mean and covariance (with ``FLOORS`` squared on the diagonal),
    which never raises the determinant. Medians and cuts are exact over quantised values
    (some thousand different ones, whatever the data), sums are exact decimals: repeated runs
    and other partitionings give the same estimates. Each step is stored, one row per group.
    """
    d = len(FLOORS)
    xs = [f"x_{i}" for i in range(d)]
    members = F.count(F.lit(1)).alias("_n")
    middle = materialize(
        rows.groupBy("g").agg(members, *[F.percentile(x, 0.5).alias(f"c_{i}") for i, x in enumerate(xs)]), "mcd")
    apart = _with(rows, middle).groupBy("g").agg(
        members, *[F.first(f"c_{i}").alias(f"c_{i}") for i in range(d)],
        *[F.percentile(F.round(F.abs(F.col(x) - F.col(f"c_{i}"))), 0.5).alias(f"d_{i}")
          for i, x in enumerate(xs)])
    spread = [F.greatest(F.col(f"d_{i}") * 1.4826 / SCALE, F.lit(FLOORS[i])) for i in range(d)]
    params = materialize(apart.select(
        "g", "_n", *[(F.col(f"c_{i}") / SCALE).alias(f"c_{i}") for i in range(d)],
        *[(1 / spread[i] if i == j else F.lit(0.0)).alias(f"m_{i}{j}") for i in range(d) for j in range(i + 1)],
    ), "mcd")
    fine = F.floor(F.log1p(_distance(d)) * _FINE).cast("int")
    for _ in range(STEPS):
        near = _with(rows, params).select("g", *xs, fine.alias("q"))
        cut = materialize(near.groupBy("g").agg(members, F.percentile("q", CORE).alias("_cut")), "mcd")
        exact = "decimal(20,0)"
        sums = _with(near, cut).filter("q <= _cut").groupBy("g").agg(
            members, F.count(F.lit(1)).cast("double").alias("n"),
            *[F.sum(x).cast("double").alias(f"t_{i}") for i, x in enumerate(xs)],
            *[F.sum((F.col(xs[i]) * F.col(xs[j])).cast(exact)).cast("double").alias(f"p_{i}{j}")
              for i in range(d) for j in range(i + 1)])
        moments = sums.select(
            "g", "_n", *[(F.col(f"t_{i}") / F.col("n") / SCALE).alias(f"c_{i}") for i in range(d)],
            *[((F.col(f"p_{i}{j}") - F.col(f"t_{i}") * F.col(f"t_{j}") / F.col("n")) / F.col("n") / SCALE**2
               + (FLOORS[i]**2 if i == j else 0.0)).alias(f"s_{i}{j}") for i in range(d) for j in range(i + 1)])
        params = materialize(_inverse_root(moments, d), "mcd")
    final = _with(rows, params).groupBy("g").agg(F.percentile(fine, 0.5).alias("_mid"))
    scale = F.greatest(F.expm1((F.col("_mid") + 1) / _FINE) / MEDIAN_5, F.lit(1.0))
    return materialize(params.drop("_n").join(final.select("g", scale.alias("scale")), "g"), "mcd")


def judged(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``stats`` (of :func:`measured`, stored) plus ``_base_failed``, ``_distance`` and ``_kept``.

    Base rules fail texts under 50 words and those with over half their words in repeated
    windows. Of the rest, a row is kept if its squared distance from its group, one per
    language and source, is at most ``CUTOFF``. NULL languages and sources are groups of
    their own; groups under ``LEAST_ROWS`` rows use the estimate over all rows. Columns of
    ``stats`` must not begin with an underscore.
    """
    n, repeat = F.col("_stats.n_words"), F.col("_stats.n_repeat_words")
    failed = (n < 50) | (repeat * 100 > n * 50)
    x = [v.alias(f"x_{i}") for i, v in enumerate(_transformed())]
    points = stats.filter(~failed).select(_group(lang, source).alias("g"), *x)
    sizes = points.groupBy("g").count().filter(F.col("count") >= LEAST_ROWS).select("g")
    large = broadcast_checked(materialize(sizes, "mcd-groups"), BROADCAST_GROUPS)
    all_rows = points.withColumn("g", F.lit("*"))
    found = estimates(materialize(
        points.join(large, "g", "left_semi").unionByName(all_rows), "mcd-points"))
    d = len(FLOORS)
    packed = F.struct(*[c for c in found.columns if c != "g"]).alias("_own")
    own = found.select(F.col("g").alias("_g"), packed)
    rest = found.filter("g = '*'").select(packed).first()
    marked = stats.withColumn("_g", _group(lang, source)).withColumn("_failed", failed)
    joined = marked.join(broadcast_checked(own, BROADCAST_GROUPS), "_g", "left")
    if rest is None:        # no row passes the base rules
        distance = F.lit(0.0)
    else:
        general = F.struct(*[F.lit(v).alias(k) for k, v in rest[0].asDict().items()])
        joined = joined.withColumn("_par", F.coalesce("_own", general))
        par = {k: F.col(f"_par.{k}") for k in rest[0].asDict()}
        values = [v / SCALE - par[f"c_{i}"] for i, v in enumerate(_transformed())]
        distance = sum(
            (F.pow(sum((par[f"m_{i}{j}"] * values[j] for j in range(i + 1)), F.lit(0.0)), 2)
             for i in range(d)), F.lit(0.0)) / par["scale"]
    return joined.select(
        *[F.col(f"`{c}`") for c in stats.columns], F.col("_failed").alias("_base_failed"),
        F.when(F.col("_failed"), F.lit(None)).otherwise(distance).cast("double").alias("_distance"),
    ).withColumn("_kept", ~F.col("_base_failed") & (F.col("_distance") <= CUTOFF))


@own_names
def quality_rules(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance,
    kept) for every row of ``docs``; NULL text counts as empty and fails the base rules."""
    slim = docs.select(*dict.fromkeys([key, text, lang, source]))
    stats = materialize(measured(slim, text).drop(text), "text-statistics")
    return judged(stats, lang, source).select(
        key, "_stats.*", F.col("_base_failed").alias("base_failed"),
        F.col("_distance").alias("distance"), F.col("_kept").alias("kept"))


@own_names
def passing(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep. Documents are stored once together with their
    statistics, which spares both a second pass over texts and a join by key."""
    stats = materialize(measured(docs, text), "text-statistics")
    return judged(stats, lang, source).filter("_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
