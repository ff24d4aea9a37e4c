"""Line dedup by winnowing, with built-in functions alone.

A document is the sequence of its lines that aren't blank.  From each line on, its window is
the shortest run of lines that has RUN of them or LONG words: so a long line counts alone.
The smallest line hash of a window (leftmost on ties) is a fingerprint: where two places
share a window, they share its fingerprint at the same place.  Fingerprints that occur twice
are joined by position and extended both ways to the windows whose minimum they are; of
equal windows the earliest (smaller id, then earlier line) stays, and lines of the others
go, with the blank lines between them.  So a run of RUN lines or LONG words, or more, goes
wherever it isn't first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import release, stored
from tessera.llm.spans import documents

#: Lines, or words (what blanks separate), that make a run long enough to compare.
RUN, LONG = 3, 50


def _sequence(n: Column) -> Column:
    """0 to n - 1, empty where n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _solid(lines: Column) -> Column:
    """Lines that aren't blank, as (hash, words, index)."""
    words = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    return F.filter(F.transform(lines, lambda x, i: F.struct(F.when(F.trim(x) != "", F.xxhash64(x)).alias("h"), words(x).alias("w"), i.alias("i"))), lambda s: s["h"].isNotNull())


def _length(lines: Column, j: Column, run: int, long: int) -> Column:
    """Lines of the window that begins at lines[j] (of h and w), null where the text ends before it does."""
    words = lambda k: sum((F.get(lines, j + x)["w"] for x in range(1, k)), F.get(lines, j)["w"])
    out = F.when(words(1) >= long, 1)
    for k in range(2, run):
        out = out.when(words(k) >= long, k)
    return out.when(j + run <= F.size(lines), run)


def repeated_windows(own: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """(_doc, _of, _start, _n; counting lines that aren't blank) of the windows that occur earlier; own: from documents()."""
    hashes = own.where("_text is not null").select(F.col("_id").alias("_doc"), F.col("_dig").alias("_of"), F.transform(_solid(_lines(F.col("_text"))), lambda s: F.struct(s["h"].alias("h"), s["w"].alias("w"))).alias("hs"))
    starts = F.filter(F.transform(_sequence(F.size("hs")), lambda j: F.struct(j.alias("j"), _length(F.col("hs"), j, run, long).alias("n"))), lambda s: s["n"].isNotNull())
    placed = F.transform("hs", lambda x, i: F.struct(x["h"].alias("h"), i.alias("p")))
    minima = F.array_distinct(F.transform("starts", lambda s: F.array_min(F.slice(F.col("placed"), s["j"] + 1, s["n"]))))
    marks = hashes.withColumn("starts", starts).withColumn("placed", placed).select("_doc", "_of", "hs", F.explode(minima).alias("m"))
    # what surrounds a fingerprint: as many lines as a window of its own can reach
    begin = F.greatest(F.lit(0), F.col("m.p") - (run - 1))
    marks = marks.select("_doc", "_of", F.col("m.h").alias("h"), F.col("m.p").alias("p"), begin.alias("b"), F.slice("hs", begin + 1, F.col("m.p") + run - begin).alias("near"))
    marks = stored(marks, "line-marks")
    twice = stored(marks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "line-twice")
    # merge joins at every size: all of these tables grow with the input
    joined = marks.join(twice.hint("merge"), "h")
    # windows inside `near` that reach the fingerprint, and of those the ones whose leftmost minimum it is
    at = F.transform(_sequence(F.col("p") - F.col("b") + 1), lambda j: F.struct(j.alias("j"), _length(F.col("near"), j, run, long).alias("n")))
    reach = F.filter(at, lambda s: s["n"].isNotNull() & (F.col("b") + s["j"] + s["n"] > F.col("p")))
    windows = joined.select("_doc", "_of", "h", "p", "b", "near", F.explode(reach).alias("s"))
    content = F.transform(F.slice("near", F.col("s.j") + 1, F.col("s.n")), lambda x: x["h"])
    windows = windows.select("_doc", "_of", (F.col("b") + F.col("s.j")).alias("start"), F.col("s.n").alias("n"), "h", "p", content.alias("w"))
    windows = windows.where((F.array_min("w") == F.col("h")) & (F.array_position("w", F.col("h")) == F.col("p") - F.col("start") + 1)).select("_doc", "_of", "start", "n", "w")
    windows = stored(windows, "line-windows")
    release(marks, twice)
    place = F.struct("_doc", "_of", "start")
    first = stored(windows.groupBy("w").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select("w", "first"), "line-first")
    later = stored(windows.join(first.hint("merge"), "w").where(place > F.col("first")).select("_doc", "_of", F.col("start").alias("_start"), F.col("n").alias("_n")), "line-later")
    release(windows, first)
    return later


def line_dedup(docs: DataFrame, run: int = RUN, long: int = LONG, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Delete later repeated runs of lines.

    With keep: docs with their texts cut (a text that loses all its lines becomes empty).
    Else (id, n_lines, n_removed, n_runs, kept_text); lines that are blank don't count.
    Lines are compared as they stand, by 64-bit hashes, a window of them together.  Null
    text: stays null, with zeros.  Empty text: stays.  Null id: untouched.  Ids that aren't
    integers: a TypeError.  Repeated rows (same id and text) count as one document; different
    texts of one id are documents one after another, by a hash of the text.  Empty table: no
    rows.  With keep other columns go along, whatever their names.
    """
    own, dig = documents(docs, id_col, text_col)
    gone = repeated_windows(own, run, long).groupBy("_doc", "_of").agg(F.array_sort(F.collect_set(F.struct(F.col("_start").alias("a"), (F.col("_start") + F.col("_n") - 1).alias("z")))).alias("_windows"))
    wanted = docs if keep else docs.select(id_col, text_col)
    # a row goes as one struct, so that no name of its columns meets those here
    rows = wanted.select(F.struct(*[F.col(f"`{c}`") for c in wanted.columns]).alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).withColumn("_dig", dig)
    df = rows.join(gone.hint("merge"), (F.col("_id") == F.col("_doc")) & (F.col("_dig") == F.col("_of")), "left").drop("_doc", "_of", "_dig")
    cut_here = F.col("_windows").isNotNull()
    lines = _lines(F.col("_text"))
    df = df.withColumn("_lines", F.when(cut_here, lines)).withColumn("_index", F.when(cut_here, F.transform(_solid(F.col("_lines")), lambda s: s["i"])))
    # runs of overlapping windows, as first and last line; a later window never ends before an earlier one
    before, behind = (lambda i: F.get("_windows", i - 1)), (lambda i: F.get("_windows", i + 1))
    firsts = F.transform(F.filter("_windows", lambda s, i: (i == 0) | (s["a"] > before(i)["z"])), lambda s: s["a"])
    lasts = F.transform(F.filter("_windows", lambda s, i: (i == F.size("_windows") - 1) | (behind(i)["a"] > s["z"])), lambda s: s["z"])
    df = df.withColumn("_runs", F.when(cut_here, F.arrays_zip(firsts.alias("a"), lasts.alias("z"))))
    a, z = F.transform("_runs", lambda r: F.element_at("_index", r["a"] + 1)), F.transform("_runs", lambda r: F.element_at("_index", r["z"] + 1))
    # what stays: from behind each run (or the beginning) to before the next (or the end)
    begins, ends = F.concat(F.array(F.lit(0)), F.transform(z, lambda x: x + 1)), F.concat(a, F.array(F.size("_lines")))
    pieces = F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")), lambda p: F.slice(F.col("_lines"), p["b"] + 1, F.greatest(p["e"] - p["b"], F.lit(0))))
    kept = F.when(cut_here, F.array_join(F.flatten(pieces), "\n")).otherwise(F.col("_text"))
    if keep:
        return df.select(*[kept.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
    removed = F.coalesce(F.aggregate("_runs", F.lit(0), lambda t, r: t + r["z"] - r["a"] + 1), F.lit(0))
    count = F.coalesce(F.size(F.filter(lines, lambda x: F.trim(x) != "")), F.lit(0))
    return df.select(F.col("_id").alias(id_col), F.when(F.col("_text").isNull(), 0).otherwise(count).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"), F.coalesce(F.when(cut_here, F.size("_runs")), F.lit(0)).cast("long").alias("n_runs"), kept.alias("kept_text"))


#: DuckDB SQL of line_dedup()'s rows, the kept text as its SHA-256.
ORACLE = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k, length(line) - length(replace(line, ' ', '')) + 1 AS words FROM l WHERE trim(line) <> ''),
v AS (
  SELECT doc_id, k, i, lead(i) OVER d AS i2, lead(i, 2) OVER d AS i3, line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c,
         CASE WHEN words >= 50 THEN 1 WHEN words + lead(words) OVER d >= 50 THEN 2 WHEN lead(i, 2) OVER d IS NOT NULL THEN 3 END AS n
  FROM s WINDOW d AS (PARTITION BY doc_id ORDER BY k)),
w AS (SELECT doc_id, k, n, i, CASE n WHEN 1 THEN i WHEN 2 THEN i2 ELSE i3 END AS z, a, CASE WHEN n > 1 THEN b END AS b, CASE WHEN n > 2 THEN c END AS c FROM v WHERE n IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS nth FROM w),
g AS (SELECT doc_id, k, n, i, z FROM r WHERE nth > 1),
x AS (SELECT l.doc_id, l.line, l.i, EXISTS (SELECT 1 FROM g WHERE g.doc_id = l.doc_id AND l.i BETWEEN g.i AND g.z) AS gone FROM l),
runs AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, k, lag(k + n - 1) OVER (PARTITION BY doc_id ORDER BY k) AS p FROM g) WHERE p IS NULL OR k > p GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) FILTER (WHERE trim(line) <> '') AS n_lines, count(*) FILTER (WHERE gone AND trim(line) <> '') AS n_removed,
         string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM x GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(runs.n, 0) AS BIGINT) AS n_runs, CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN runs USING (doc_id)
"""
