"""Quality rules: robust multivariate outliers by language and source.

Counts of each text come from array functions. Four statistics of it (word length, symbols, repeated
lines, repeated words) are set against a minimum-covariance-determinant estimate of its group: the
mean and covariance of the most central three quarters of the group's texts, found from two robust
starts by concentration steps; the one with the smaller determinant counts. Texts at a Mahalanobis
distance beyond the cut are rejected.

Statistics are whole numbers in units of 1/1024, so that sums are exact and the result does not
depend on how rows are dealt. The steps are SQL statements that Spark and other engines both read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscore.llm.stored import stored

#: Rows of a group; sources with fewer are pooled by language, then over all.
LEAST_ROWS = 100
#: Share of a group that the estimate rests on.
CENTRAL = 0.75
#: Makes the covariance of the central share that of all rows, for normal data in 4 dimensions.
CONSISTENCY = 1.486
#: Squared distance of 0.9999 of normal rows in 4 dimensions.
CUT = 23.51
STEPS = 3
UNIT = 1024
#: Spread that is always tolerated, of each statistic: its square is added to the variance.
TOLERANCES = (0.1, 0.04, 0.12, 0.12)

_P = range(1, len(TOLERANCES) + 1)
_PAIRS = [(i, j) for i in _P for j in _P if j <= i]
_BLANK = r"[\x20\x09-\x0D]+"


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row however often they are read."""
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def _repeated() -> Column:
    """Words in three-word windows that occur twice or more, from the hashes of all windows."""

    def places(ordered: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - 1), F.get(ordered, i + 1)
            same = F.coalesce(x["h"] == before["h"], F.lit(False))
            return same | F.coalesce(x["h"] == after["h"], F.lit(False))

        found = F.transform(F.filter(ordered, again), lambda x: x["i"])
        none = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))

        def step(done: Column, place: Column) -> Column:
            n = done["n"] + F.least(F.lit(3), place - done["last"])
            return F.struct(n.alias("n"), place.alias("last"))

        return F.aggregate(F.sort_array(found), none, step, lambda done: done["n"])

    numbered = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = F.array(F.sort_array(numbered))
    slow = F.element_at(F.transform(ordered, places), 1)
    distinct = F.size(F.array_distinct("windows")) == F.size("windows")
    return F.when(distinct, F.lit(0)).otherwise(slow)


def text_counts(docs: DataFrame) -> DataFrame:
    """`doc_id`, `lang`, `source`, a hash of the text, its counts and the base verdict.

    A null text has no words. Windows are told apart by 64-bit hashes.
    """
    rows = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    rows = _once(
        rows,
        words=F.array_remove(F.split("text", _BLANK), ""),
        lines=F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    )

    def window(word: Column, i: Column) -> Column:
        return F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2))

    count = F.greatest(F.size("words") - 2, F.lit(0))
    rows = _once(rows, windows=F.slice(F.transform("words", window), F.lit(1), count))
    without = F.regexp_replace("text", r"[#*$%&|<>]", "")
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.length("text") - F.length(without),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeated(),
        "n_lines": F.size("lines"),
    }
    counted = rows.select(
        "doc_id",
        "lang",
        "source",
        F.xxhash64("text").alias("text_key"),
        *[value.cast("bigint").alias(name) for name, value in counts.items()],
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


# SQL that takes {counted}, {rows} and so on as tables. Spaces around || keep strings readable.

STATISTICS = f"""
    CAST(floor({UNIT} * log2(word_chars / n_words) + 0.5) AS BIGINT) AS x1,
    CAST(floor({UNIT} * sqrt(n_symbols / word_chars) + 0.5) AS BIGINT) AS x2,
    CAST(floor({UNIT} * (n_dup_lines / n_lines) + 0.5) AS BIGINT) AS x3,
    CAST(floor({UNIT} * (n_repeat_words / n_words) + 0.5) AS BIGINT) AS x4"""

#: Group of each language and source, with the rows that are not rejected already.
GROUPS = f"""
SELECT lang, source, CASE
    WHEN n >= {LEAST_ROWS} THEN concat('2', length(coalesce(lang, '')), coalesce('+' || lang, '-'),
        coalesce('+' || source, '-'))
    WHEN pooled >= {LEAST_ROWS} THEN concat('1', coalesce('+' || lang, '-'))
    WHEN rest >= {LEAST_ROWS} THEN '0' END AS g
FROM (
    SELECT *, sum(CASE WHEN n < {LEAST_ROWS} AND pooled < {LEAST_ROWS} THEN n END)
        OVER () AS rest
    FROM (
        SELECT *, sum(CASE WHEN n < {LEAST_ROWS} THEN n END) OVER (PARTITION BY lang) AS pooled
        FROM (SELECT lang, source, count(*) AS n FROM {{counted}} WHERE NOT base_failed
            GROUP BY lang, source) a
    ) b
) c
"""

ROWS = f"""
SELECT c.doc_id, c.lang, c.source, c.text_key, groups.g, {STATISTICS}
FROM {{counted}} c JOIN {{groups}} groups
    ON c.lang IS NOT DISTINCT FROM groups.lang AND c.source IS NOT DISTINCT FROM groups.source
WHERE NOT base_failed AND groups.g IS NOT NULL
"""


def _each(form: str, join: str = ", ") -> str:
    return join.join(form.format(i=i) for i in _P)


CENTRES = f"""
SELECT g, {_each("percentile_disc(0.5) WITHIN GROUP (ORDER BY x{i}) AS m{i}")}
FROM {{rows}} GROUP BY g
"""

#: Medians and median deviations as a first estimate, once for each way to measure a distance.
STARTS = f"""
SELECT g, start, {_each("CAST(m{i} AS DOUBLE) AS m{i}")}, {", ".join(
    f"1 / sqrt(2.1981 * s{i} * s{i} + {(UNIT * TOLERANCES[i - 1]) ** 2!r}) AS a{i}{j}"
    if i == j else f"CAST(0 AS DOUBLE) AS a{i}{j}" for i, j in _PAIRS)}
FROM (
    SELECT r.g, {_each("min(m{i}) AS m{i}")},
        {_each("percentile_disc(0.5) WITHIN GROUP (ORDER BY abs(x{i} - m{i})) AS s{i}")}
    FROM {{rows}} r JOIN {{centres}} c ON r.g = c.g GROUP BY r.g
) spread CROSS JOIN (SELECT 0 AS start UNION ALL SELECT 1 AS start) both_starts
"""


def _axis(i: int) -> str:
    return "(" + " + ".join(f"a{i}{j} * (x{j} - m{j})" for j in range(1, i + 1)) + ")"


DISTANCE = " + ".join(f"{_axis(i)} * {_axis(i)}" for i in _P)
_WIDEST = f"greatest({', '.join(f'abs({_axis(i)})' for i in _P)})"
#: The second start measures by the widest axis alone.
FIRST_DISTANCE = f"CASE WHEN start = 0 THEN {DISTANCE} ELSE 4 * {_WIDEST} * {_WIDEST} END"


def _placed(distance: str) -> str:
    """Rows with their distance as one of a few thousand steps."""
    return f"""(
    SELECT r.*, start, CAST(floor(64 * log2(1 + {distance})) AS BIGINT) AS d
    FROM {{rows}} r JOIN {{estimates}} e ON r.g = e.g)"""


def cuts(distance: str) -> str:
    """The distance that holds the central share of each group."""
    return f"""
SELECT g, start, percentile_disc({CENTRAL}) WITHIN GROUP (ORDER BY d) AS central
FROM {_placed(distance)} placed GROUP BY g, start
"""


_COVARIANCE = ", ".join(
    f"{CONSISTENCY} * (s{i}{j} / n - m{i} * m{j})"
    + (f" + {(UNIT * TOLERANCES[i - 1]) ** 2!r}" if i == j else "")
    + f" AS c{i}{j}"
    for i, j in _PAIRS
)


def _factor(i: int, j: int) -> str:
    """An entry of the lower triangular factor of the covariance."""
    less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
    return f"sqrt(c{i}{i}{less})" if i == j else f"(c{i}{j}{less}) / l{j}{j}"


def _inverse(i: int, j: int) -> str:
    """An entry of the inverse of that factor."""
    if i == j:
        return f"1 / l{i}{i}"
    return "-(" + " + ".join(f"l{i}{k} * a{k}{j}" for k in range(j, i)) + f") / l{i}{i}"


def estimates(distance: str) -> str:
    """Mean and inverse factor of the covariance of the central rows."""
    sums = ", ".join(f"sum(x{i} * x{j}) AS s{i}{j}" for i, j in _PAIRS)
    return f"""
SELECT g, start, {_each("m{i}")}, {", ".join(f"a{i}{j}" for i, j in _PAIRS)}, size
FROM (
    SELECT *, {", ".join(f"{_inverse(i, j)} AS a{i}{j}" for i, j in _PAIRS)},
        {_each("ln(l{i}{i})", " + ")} AS size
    FROM (
        SELECT *, {", ".join(f"{_factor(i, j)} AS l{i}{j}" for i, j in _PAIRS)}
        FROM (
            SELECT *, {_COVARIANCE}
            FROM (
                SELECT *, {_each("s{i} / n AS m{i}")}
                FROM (
                    SELECT p.g, p.start, count(*) AS n, {_each("sum(x{i}) AS s{i}")}, {sums}
                    FROM {_placed(distance)} p JOIN {{cuts}} k ON p.g = k.g AND p.start = k.start
                    WHERE d <= central GROUP BY p.g, p.start
                ) summed
            ) centred
        ) spread
    ) factored
) inverted
"""


#: Of the starts of a group, the one with the smallest determinant.
BEST = """
SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY size, start) AS place FROM {estimates}
) ranked WHERE place = 1
"""

OUTLIERS = f"""
SELECT r.doc_id, r.lang, r.source, r.text_key
FROM {{rows}} r JOIN {{best}} e ON r.g = e.g WHERE {DISTANCE} > {CUT}
"""


def outliers(counted: DataFrame) -> DataFrame:
    """The rows of `text_counts` that are rejected by distance: id, language, source, text hash."""
    spark = counted.sparkSession

    def run(sql: str, name: str, **tables: DataFrame) -> DataFrame:
        return stored(spark.sql(sql, **tables), f"quality-{name}")

    groups = run(GROUPS, "groups", counted=counted)
    rows = run(ROWS, "rows", counted=counted, groups=groups)
    centres = run(CENTRES, "centres", rows=rows)
    found = run(STARTS, "estimates", rows=rows, centres=centres)
    for step in range(STEPS):
        distance = DISTANCE if step else FIRST_DISTANCE
        central = run(cuts(distance), "cuts", rows=rows, estimates=found)
        found = run(estimates(distance), "estimates", rows=rows, estimates=found, cuts=central)
    return spark.sql(OUTLIERS, rows=rows, best=spark.sql(BEST, estimates=found))


_KEY = ("doc_id", "lang", "source", "text_key")


def _same(left: DataFrame, right: DataFrame) -> Column:
    same = F.lit(True)
    for name in _KEY:
        same = same & left[name].eqNullSafe(right[name])
    return same


def verdicts(docs: DataFrame) -> DataFrame:
    """Per document: `doc_id`, the counts, `base_failed` and `kept`.

    Reads `doc_id`, `text`, `lang` and `source`; other columns are not touched. A null text counts as
    empty and fails the base rule. Nulls in lang or source are groups of their own; a group too small
    for an estimate even when pooled keeps all that pass the base rule. Rows that repeat get the same
    verdict. An empty table gives an empty result. Group estimates are single rows and are joined, so
    a hot group is never in one task.
    """
    counted = stored(text_counts(docs), "quality-counts")
    bad = outliers(counted).distinct().withColumn("outlier", F.lit(True))
    joined = counted.join(bad, _same(counted, bad), "left")
    kept = ~counted["base_failed"] & bad["outlier"].isNull()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return joined.select(counted["doc_id"], *[counted[n] for n in names], kept.alias("kept"))


def good_rows(docs: DataFrame) -> DataFrame:
    """The rows that are kept by `verdicts`; all columns pass through."""
    counted = stored(text_counts(docs), "quality-counts")
    bad = counted.where("base_failed").select(*_KEY).union(outliers(counted)).distinct()
    whole = docs.select(
        F.struct("*").alias("whole"),
        "doc_id",
        "lang",
        "source",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
    )
    return whole.join(bad, _same(whole, bad), "left_anti").select("whole.*")
