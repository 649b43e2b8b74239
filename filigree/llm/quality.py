"""Quality rules: fixed base rules, then robust multivariate outliers by language and source.

DataFrame functions only. Five statistics of a text (words, code points in words, symbols, repeated
lines, repeated words) become a vector of five whole numbers, thousandths of logarithms and shares.
For every language and source the minimum covariance determinant is estimated over all rows that
pass the base rules: the three quarters of the rows whose covariance has the smallest determinant.
Three starts (medians and their deviations, all rows, the rows near the medians) take two
concentration steps each, the one with the smallest determinant takes four more; the covariance is
made consistent with a normal one and weighed anew over the rows within its 97.5 % ellipsoid. A row
whose squared Mahalanobis distance is beyond ``REJECT`` is an outlier.

* Most texts have no symbol, repeated line or repeated word, so that the best three quarters have no
  variance there. ``FLOORS``, the least spread of a statistic that counts as one, is added to the
  variances throughout.
* Languages and sources with fewer than ``LEAST_ROWS`` rows are estimated together: those of a
  language, and where these are too few, all of them. Where even these are too few, nothing is an outlier.
* Estimates are written tables with a row for each group; Spark broadcasts them by their size, and joins by
  shuffle, split where a group is large, if there are too many.
* The distance up to which the three quarters reach comes from counts by bins of one percent, at most
  ``BINS`` a group, so that no group is ever sorted. All sums are of whole numbers, so neither the order
  of the rows nor their partitions change a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.common import stage

SPACE = " \t\n\x0b\f\r"
WINDOW = 5
LEAST_WORDS, REPEATED_PERCENT = 10, 20
LEAST_ROWS, BINS = 50, 4000
FIRST_STEPS, MORE_STEPS = 2, 4
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# The transformed statistics in thousandths, and the least spread of each.
VECTOR = (
    "ln(cast(n_words as double))",
    "ln((word_chars + 100) / cast(n_words + 20 as double))",
    "ln(1 + 100 * n_symbols / cast(word_chars + 100 as double))",
    "ln(cast(1 + n_dup_lines as double))",
    "n_repeat_words / cast(n_words + 20 as double)",
)
FLOORS = (500, 50, 250, 500, 100)
# Quantiles of chi squared with five degrees: 97.5 % and all but one in a million; and what makes the
# covariance of the innermost 75 % and 97.5 % of a normal sample consistent.
INNER, REJECT = 12.8325, 35.8573
CONSISTENT_75, CONSISTENT_975 = 1.41207, 1.05553

DIMS = range(1, len(VECTOR) + 1)
PAIRS = [(i, j) for i in DIMS for j in DIMS if j <= i]
Z = [f"z{j}" for j in DIMS]
ESTIMATE = [*(f"m{j}" for j in DIMS), *(f"c{i}{j}" for i, j in PAIRS)]
FAILED = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {REPEATED_PERCENT} * n_words"

# Expressions that Spark and the SQL form share: columns by name, in levels that build on the ones before.
Level = dict[str, str]
SCALED: Level = {f"z{j}": f"cast(floor(1000 * {x} + 0.5) as bigint)" for j, x in zip(DIMS, VECTOR, strict=True)}
MOMENTS: Level = {"n": "count(*)"} | {f"s{j}": f"sum(cast(z{j} as decimal(20, 0)))" for j in DIMS} | {f"p{i}{j}": f"sum(cast(z{i} * z{j} as decimal(20, 0)))" for i, j in PAIRS}


def _spread(factor: float) -> list[Level]:
    """Means and the covariance, made consistent by ``factor``, with the floors added."""
    own = lambda i, j: f" + {float(FLOORS[i - 1] ** 2)!r}" if i == j else ""
    return [{f"m{j}": f"cast(s{j} as double) / n" for j in DIMS}, {f"c{i}{j}": f"(cast(p{i}{j} as double) / n - m{i} * m{j}) * cast({factor!r} as double){own(i, j)}" for i, j in PAIRS}]


def _at(i: int, j: int) -> str:
    return f"c{max(i, j)}{min(i, j)}"


def _swept(k: int) -> Level:
    """The covariance after sweeping out column ``k``; after all of them it is the negated inverse."""
    d = _at(k, k)
    entry = lambda i, j: f"-1 / {d}" if i == j == k else f"{_at(i, j)} / {d}" if k in (i, j) else f"{_at(i, j)} - {_at(i, k)} * {_at(k, j)} / {d}"
    return {_at(i, j): entry(i, j) for i, j in PAIRS} | {"volume": f"volume + ln({d})"}


SIZE = len(VECTOR)
# The same sweeps in one expression over the matrix as an array, row by row, with the logarithm of the determinant behind.
SWEEP = f"""aggregate(sequence(0, {SIZE - 1}), matrix, (c, k) -> transform(c, (x, at) -> case
    when at = {SIZE * SIZE} then x + ln(c[k * {SIZE + 1}])
    when at = k * {SIZE + 1} then -1 / c[k * {SIZE + 1}]
    when cast(floor(at / {SIZE}) as int) = k or at % {SIZE} = k then x / c[k * {SIZE + 1}]
    else x - c[cast(floor(at / {SIZE}) as int) * {SIZE} + k] * c[k * {SIZE} + at % {SIZE}] / c[k * {SIZE + 1}] end))"""
OFF = {j: f"(z{j} - m{j})" for j in DIMS}
DISTANCE: Level = {"d2": "-(" + " + ".join(f"{_at(i, j)} * {OFF[i]} * {OFF[j]}" + (" * 2" if i > j else "") for i, j in PAIRS) + ")"}
BIN = f"cast(least({BINS}, floor(100 * ln(1 + d2))) as bigint)"
START: Level = {f"m{j}": f"cast(med{j} as double)" for j in DIMS} | {f"c{i}{j}": f"(1.4826 * mad{i}) * (1.4826 * mad{i}) + {float(FLOORS[i - 1] ** 2)!r}" if i == j else "cast(0 as double)" for i, j in PAIRS}
NEAR = " and ".join(f"abs(z{j} - med{j}) <= 2.5 * (1.4826 * mad{j} + {FLOORS[j - 1]})" for j in DIMS)


def _with(df: DataFrame, *levels: Level) -> DataFrame:
    for level in levels:
        df = df.withColumns({name: F.expr(x) for name, x in level.items()})
    return df


def _inverted(df: DataFrame) -> DataFrame:
    """``(key, start, volume)``, means and negated inverse from the covariances of ``df``."""
    matrix = F.array(*[F.col(_at(i, j)) for i in DIMS for j in DIMS], F.lit(0.0))
    swept = df.withColumn("matrix", matrix).withColumn("matrix", F.expr(SWEEP))
    entries = [F.get("matrix", F.lit((i - 1) * SIZE + j - 1)).alias(_at(i, j)) for i, j in PAIRS]
    return swept.select("key", "start", F.get("matrix", F.lit(SIZE * SIZE)).alias("volume"), *[f"m{j}" for j in DIMS], *entries)


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once for each row."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def repeated_words(words: str) -> Column:
    """How many words of the array ``words`` lie in a window of ``WINDOW`` words found more than once in it.

    Windows are compared by a 64-bit hash inside the row. Only rows in which a hash comes back are
    looked at more closely: hashes are sorted with their places, and the places of equal ones counted up.
    """
    window = ", ".join(f"w[i + {k}]" for k in range(1, WINDOW))
    hashes = f"transform(slice(w, 1, size(w) - {WINDOW - 1}), (x, i) -> xxhash64(x, {window}))"
    covered = f"aggregate(transform(p, (x, j) -> least({WINDOW}, coalesce(get(p, j + 1) - x, {WINDOW}))), 0L, (total, x) -> total + x)"
    places = "array_sort(transform(filter(s, (e, j) -> get(s, j - 1).g <=> e.g or get(s, j + 1).g <=> e.g), e -> e.i))"
    ordered = "array_sort(transform(g, (x, i) -> struct(x as g, i as i)))"
    often = f"if(size(array_distinct(g)) < size(g), {_bound(ordered, 's', _bound(places, 'p', covered))}, 0L)"
    return F.expr(_bound(words, "w", f"if(size(w) < {WINDOW}, 0L, {_bound(hashes, 'g', often)})"))


def statistics(docs: DataFrame, carried: Column, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(row, lang, source)``, the statistics and ``base_failed`` of every row; ``row`` is what ``carried`` says."""
    named = docs.select(carried.alias("row"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    trimmed = F.trim("t", F.lit(SPACE))
    split = named.withColumn("w", F.when(F.length(trimmed) > 0, F.split(trimmed, "[ \\t-\\r]+")).otherwise(F.array().cast("array<string>")))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.length(F.trim(x, F.lit(SPACE))) > 0)
    listed = split.withColumn("lines", lines)
    wide = listed.select(
        "row", "lang", "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", "[ \\t-\\r]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words("w").alias("n_repeat_words"),
    )
    return wide.withColumn("base_failed", F.expr(FAILED))


def _name(part: str) -> Column:
    """A name for each value, null included; no two values of a pair of parts share one."""
    return F.coalesce(F.concat(F.length(part), F.lit(":"), F.col(part)), F.lit("null"))


def grouped(table: DataFrame) -> DataFrame:
    """The group of each language and source: ``(lang, source, key)``; ``key`` is null where rows are too few."""
    sizes = table.where("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    few = sizes.where(F.col("n") < LEAST_ROWS)
    by_lang = few.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    rest = by_lang.where(F.col("n_lang") < LEAST_ROWS).agg(F.sum("n_lang").alias("n_rest"))
    joined = sizes.alias("s").join(by_lang.alias("b"), F.col("s.lang").eqNullSafe(F.col("b.lang")), "left").crossJoin(rest)  # one row
    key = F.when(F.col("n") >= LEAST_ROWS, F.concat(F.lit("group "), _name("s.lang"), F.lit(" "), _name("s.source"))).when(F.col("n_lang") >= LEAST_ROWS, F.concat(F.lit("rest "), _name("s.lang"))).when(F.col("n_rest") >= LEAST_ROWS, F.lit("rest"))
    return joined.select(F.col("s.lang").alias("lang"), F.col("s.source").alias("source"), key.alias("key"))


def _keyed(table: DataFrame, keys: DataFrame) -> DataFrame:
    same = F.col("t.lang").eqNullSafe(F.col("k.lang")) & F.col("t.source").eqNullSafe(F.col("k.source"))
    return table.alias("t").join(keys.alias("k"), same, "left").select("t.*", "k.key")


def _measured(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the squared distance ``d2`` to each estimate of their group."""
    return _with(rows.join(estimates.select("key", "start", *ESTIMATE), "key", how), DISTANCE).drop(*ESTIMATE)


def _moments(rows: DataFrame, factor: float = 1.0) -> DataFrame:
    """The estimates of ``rows``, one for each ``key`` and ``start``, as a written table."""
    summed = rows.groupBy("key", "start").agg(*[F.expr(x).alias(name) for name, x in MOMENTS.items()])
    return stage(_inverted(_with(summed, *_spread(factor))))


def _concentrated(rows: DataFrame, estimates: DataFrame, factor: float = 1.0) -> DataFrame:
    """One step: the estimates of the three quarters of the rows that are nearest to ``estimates``."""
    near = _measured(rows, estimates).withColumn("bin", F.expr(BIN)).drop("d2")
    sizes = near.groupBy("key", "start", "bin").agg(F.count("*").alias("n"))
    group = Window.partitionBy("key", "start")
    reached = sizes.select("key", "start", "bin", F.sum("n").over(group.orderBy("bin")).alias("upto"), F.sum("n").over(group).alias("total"))
    cuts = reached.where("4 * upto >= 3 * total").groupBy("key", "start").agg(F.min("bin").alias("cut"))
    return _moments(near.join(cuts, ["key", "start"]).where("bin <= cut"), factor)


def _medians(counts: DataFrame, to: str) -> DataFrame:
    """The median of each ``key`` and ``dim`` from ``counts(key, dim, value, n)``, the lower of two."""
    group = Window.partitionBy("key", "dim")
    reached = counts.select("key", "dim", "value", F.sum("n").over(group.orderBy("value")).alias("upto"), F.sum("n").over(group).alias("total"))
    return reached.where("2 * upto >= total").groupBy("key", "dim").agg(F.min("value").alias(to))


def estimated(rows: DataFrame) -> DataFrame:
    """The final estimate of each group of ``rows(key, z1, ..., z5)``, which are a written table."""
    listed = F.posexplode(F.array(*Z)).alias("dim", "value")
    counts = stage(rows.select("key", listed).groupBy("key", "dim", "value").agg(F.count("*").alias("n")))
    medians = _medians(counts, "med")
    away = counts.join(medians, ["key", "dim"]).groupBy("key", "dim", F.abs(F.col("value") - F.col("med")).alias("value")).agg(F.sum("n").alias("n"))
    both = medians.join(_medians(away, "mad"), ["key", "dim"])
    wide = [F.max(F.when(F.col("dim") == j - 1, F.col(name))).alias(f"{name}{j}") for name in ("med", "mad") for j in DIMS]
    middle = stage(both.groupBy("key").agg(*wide))
    first = _inverted(_with(middle.withColumn("start", F.lit(0)), START))
    sets = F.expr(f"explode(if({NEAR}, array(1, 2), array(1)))").alias("start")
    others = _moments(rows.join(middle, "key").select("key", *Z, sets))
    estimates = stage(first.unionByName(others))
    for _ in range(FIRST_STEPS):
        estimates = _concentrated(rows, estimates)
    best = F.min_by(F.struct("start", *ESTIMATE), F.struct("volume", "start")).alias("e")
    estimates = estimates.groupBy("key").agg(best).select("key", "e.*")
    for k in range(MORE_STEPS):
        estimates = _concentrated(rows, estimates, CONSISTENT_75 if k == MORE_STEPS - 1 else 1.0)
    return _moments(_measured(rows, estimates).where(F.col("d2") <= INNER), CONSISTENT_975)


def _judged(table: DataFrame, keys: DataFrame, estimates: DataFrame) -> DataFrame:
    """``table`` with the squared ``distance`` (null without an estimate) and ``kept``."""
    vectors = _with(_keyed(table, keys), {name: f"case when not base_failed then {x} end" for name, x in SCALED.items()})
    far = _measured(vectors, estimates, "left").withColumnRenamed("d2", "distance")
    return far.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= REJECT, F.lit(True)))


def _fitted(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    keys = stage(grouped(table))
    rows = _with(_keyed(table.where("not base_failed"), keys).where("key is not null"), SCALED).select("key", *Z)
    return keys, estimated(stage(rows))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept)`` for every row.

    A null text has no words and fails. Null languages and sources are groups of their own. Rows are
    judged by what they hold, so repeated rows and rows without an id are nothing special; equal rows
    get equal verdicts. An empty table gives an empty result; other columns are not read.
    """
    table = stage(statistics(docs, F.col(id_col), text_col, lang_col, source_col))
    judged = _judged(table, *_fitted(table))
    return judged.select(F.col("row").alias(id_col), *STATISTICS, "base_failed", "distance", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, all columns kept."""
    table = statistics(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), text_col, lang_col, source_col)
    return _judged(table, *_fitted(stage(table.drop("row")))).where("kept").select("row.*")


def _sql() -> str:
    listed = lambda level: ", ".join(f"{x} AS {name}" for name, x in level.items())
    estimate, z, moments = ", ".join(ESTIMATE), ", ".join(Z), listed(MOMENTS)
    tables: list[tuple[str, str]] = []

    def table(name: str, body: str) -> str:
        tables.append((name, body))
        return name

    def inverted(source: str, *levels: Level) -> str:
        for level in levels:
            source = f"SELECT *, {listed(level)} FROM ({source})"
        source = f"SELECT *, 0.0::DOUBLE AS volume FROM ({source})"
        for k in DIMS:
            source = f"SELECT * REPLACE ({listed(_swept(k))}) FROM ({source})"
        return f"SELECT key, start, volume, {estimate} FROM ({source})"

    def measured(source: str) -> str:
        return f"SELECT *, {listed(DISTANCE)} FROM ({source})"

    def concentrated(name: str, before: str, factor: float = 1.0) -> str:
        near = table(f"{name}_near", f"SELECT key, start, {z}, {BIN} AS bin FROM ({measured(f'SELECT * FROM v JOIN (SELECT key, start, {estimate} FROM {before}) USING (key)')})")
        cut = table(f"{name}_cut", f"SELECT key, start, min(bin) AS cut FROM (SELECT key, start, bin, sum(count(*)) OVER (PARTITION BY key, start ORDER BY bin) AS upto, sum(count(*)) OVER (PARTITION BY key, start) AS total FROM {near} GROUP BY key, start, bin) WHERE 4 * upto >= 3 * total GROUP BY key, start")
        return table(name, inverted(f"SELECT key, start, {moments} FROM {near} JOIN {cut} USING (key, start) WHERE bin <= cut GROUP BY key, start", *_spread(factor)))

    table("d", r"SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents")
    table("g", f"SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)")
    table("o", "SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1")
    table("q", f"SELECT r, sum(least({WINDOW}, coalesce(step, {WINDOW})))::BIGINT AS n FROM (SELECT r, lead(i) OVER (PARTITION BY r ORDER BY i) - i AS step FROM o) GROUP BY r")
    table("x", r"""SELECT d.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(own) - len(list_distinct(own)))::BIGINT AS n_dup_lines, coalesce(q.n, 0)::BIGINT AS n_repeat_words
        FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS own FROM d) d LEFT JOIN q USING (r)""")
    table("s", f"SELECT r, doc_id, lang, source, {', '.join(STATISTICS)}, {FAILED} AS base_failed FROM x")
    table("n", "SELECT lang, source, count(*) AS n FROM s WHERE NOT base_failed GROUP BY lang, source")
    table("b", f"SELECT lang, sum(n) AS n_lang FROM n WHERE n < {LEAST_ROWS} GROUP BY lang")
    name = lambda x: f"coalesce(length({x}) || ':' || {x}, 'null')"
    table("k", f"""SELECT n.lang, n.source, CASE WHEN n >= {LEAST_ROWS} THEN 'group ' || {name('n.lang')} || ' ' || {name('n.source')} WHEN n_lang >= {LEAST_ROWS} THEN 'rest ' || {name('n.lang')}
        WHEN (SELECT sum(n_lang) FROM b WHERE n_lang < {LEAST_ROWS}) >= {LEAST_ROWS} THEN 'rest' END AS key FROM n LEFT JOIN b ON n.lang IS NOT DISTINCT FROM b.lang""")
    table("u", f"SELECT s.*, k.key, {listed({a: f'CASE WHEN NOT base_failed THEN {x} END' for a, x in SCALED.items()})} FROM s LEFT JOIN k ON s.lang IS NOT DISTINCT FROM k.lang AND s.source IS NOT DISTINCT FROM k.source")
    table("v", f"SELECT key, {z} FROM u WHERE NOT base_failed AND key IS NOT NULL")
    table("med", f"SELECT key, {', '.join(f'quantile_disc({c}, 0.5) AS med{j}' for j, c in zip(DIMS, Z, strict=True))} FROM v GROUP BY key")
    table("mid", f"SELECT key, {', '.join(f'any_value(med{j}) AS med{j}, quantile_disc(abs(z{j} - med{j}), 0.5) AS mad{j}' for j in DIMS)} FROM v JOIN med USING (key) GROUP BY key")
    sets = f"SELECT key, 1 AS start, {z} FROM v UNION ALL SELECT key, 2, {z} FROM v JOIN mid USING (key) WHERE {NEAR}"
    table("e0", f"{inverted('SELECT *, 0 AS start FROM mid', START)} UNION ALL {inverted(f'SELECT key, start, {moments} FROM ({sets}) GROUP BY key, start', *_spread(1.0))}")
    last = "e0"
    for k in range(FIRST_STEPS):
        last = concentrated(f"e{k + 1}", last)
    last = table("f0", f"SELECT * FROM {last} QUALIFY row_number() OVER (PARTITION BY key ORDER BY volume, start) = 1")
    for k in range(MORE_STEPS):
        last = concentrated(f"f{k + 1}", last, CONSISTENT_75 if k == MORE_STEPS - 1 else 1.0)
    inner = f"SELECT key, start, {moments} FROM ({measured(f'SELECT * FROM v JOIN (SELECT key, start, {estimate} FROM {last}) USING (key)')}) WHERE d2 <= {INNER} GROUP BY key, start"
    table("final", inverted(inner, *_spread(CONSISTENT_975)))
    ctes = ",\n".join(f"{a} AS MATERIALIZED ({body})" for a, body in tables)
    return f"""WITH {ctes}
SELECT doc_id, {', '.join(STATISTICS)}, base_failed, NOT base_failed AND coalesce(d2 <= {REJECT}, true) AS kept
FROM ({measured(f'SELECT * FROM u LEFT JOIN (SELECT key, {estimate} FROM final) USING (key)')})"""


SQL = _sql()
