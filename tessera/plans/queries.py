"""Named queries over the surrogate reads, and the SQL that states each of them anew for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import duplex
from tessera.functions import seq as S

from tessera.operators import barcodes, cells, demux, order, primers, sequences, variants

from tessera.plans import results, surrogate
from tessera.plans.surrogate import PANEL, PARAMS, READS, TARGETS, Steps

RUN_ID = "00000000-0000-4000-8000-000000000000"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate.reads(spark, sf_dir).select("read_index", "read_id", "gene_class", "target", F.col("fq1").alias("r1_seq"), F.col("q1").alias("r1_qual"), F.col("fq2").alias("r2_seq"), F.col("q2").alias("r2_qual"))


def r9(c) -> F.Column:
    return F.round(c, 9)


FWD, REV = PANEL[0][2], PANEL[0][3]
CODES = list(S.RANKS)
COLS = ["R1k", *CODES[1:]]

# ---- SQL parts: each is a list of common table expressions that builds on those before
_reads = f"reads AS ({READS})"
_mean = lambda q: f"coalesce(list_sum(list_transform(string_split({q}, ''), lambda c: ascii(c) - 33)), 0) / greatest(length({q}), 1)"
_qc = _reads + f""", qc AS (SELECT read_index, CASE
 WHEN length(fq1) < 130 OR length(fq2) < 130 OR length(fq1) <> length(q1) OR length(fq2) <> length(q2) THEN 'read_length_or_quality_length'
 WHEN {_mean('q1')} < 25 OR {_mean('q2')} < 25 THEN 'mean_phred' WHEN length(fq2) < 20 THEN 'barcode_length'
 WHEN len(list_filter(string_split(substr(q2, 1, 20), ''), lambda c: ascii(c) - 33 >= 25)) < 15 THEN 'barcode_q25' END AS qc_reason FROM reads)"""


def _start_sql(seq: str, primer: str) -> str:
    n = len(primer)
    tries = ", ".join(f"{{'d': levenshtein('{primer}', substr({seq}, CAST(st + 1 AS INT), {m})), 'ok': length(substr({seq}, CAST(st + 1 AS INT), {m})) = {m}}}" for m in range(n - 2, n + 3))
    return f"(SELECT arg_min(st, d * 100 + st) FROM (SELECT st, list_min(list_transform(list_filter([{tries}], lambda x: x.ok AND x.d <= 4), lambda x: x.d)) AS d FROM range(10) AS g(st)) WHERE d IS NOT NULL)"


def _match_sql(seq: str, primer: str, centre: int) -> str:
    parts = [f"(length(substr({seq}, {s + 1}, {m})) = {m} AND " + (f"hamming('{p}', substr({seq}, {s + 1}, {m})) <= 4)" if m == len(p) else f"levenshtein('{p}', substr({seq}, {s + 1}, {m})) <= 4)") for p, s, m in S.windows(primer, 4, 4, centre)]
    # equal lengths are compared only where the window is whole
    return "(" + " OR ".join(x.replace("hamming(", "_ham(") for x in parts) + ")"


_ham = "_ham"
_MACRO_HAM = "CASE WHEN length({a}) = length({b}) THEN hamming({a}, {b}) END"


def _expand(sql: str) -> str:
    """_ham('p', x) written out, so that windows of another length aren't compared."""
    out, i = "", 0
    while (j := sql.find("_ham(", i)) >= 0:
        k = sql.index("', ", j)
        a, depth, e = sql[j + 5 : k + 1], 1, k + 3
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[e], 0)
            e += 1
        out, i = out + sql[i:j] + _MACRO_HAM.format(a=a, b=sql[k + 3 : e - 1]), e
    return out + sql[i:]


_bc = _reads + """, bc0 AS (SELECT barcode, count(*) AS n, min(CASE gene_class WHEN '16s' THEN 0 WHEN 'target' THEN 1 ELSE 2 END * 1000000000 + read_index) AS first FROM reads GROUP BY barcode),
bc AS (SELECT *, row_number() OVER (ORDER BY n DESC, first) AS rk FROM bc0)"""
_cl = _bc + """, cl(rk, doms, barcode, cell) AS (
 SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST('' AS VARCHAR), CAST('' AS VARCHAR)
 UNION ALL
 SELECT y.rk, CASE WHEN y.m IS NULL THEN list_append(y.doms, y.barcode) ELSE y.doms END, y.barcode, coalesce(y.m, y.barcode)
 FROM (SELECT b.rk, c.doms, b.barcode, list_filter(c.doms, lambda d: d = b.barcode OR substr(d, 2) = substr(b.barcode, 1, length(b.barcode) - 1) OR substr(b.barcode, 2) = substr(d, 1, length(d) - 1))[1] AS m
       FROM cl c JOIN bc b ON b.rk = c.rk + 1) y),
cells AS (SELECT barcode, cell, rk FROM cl WHERE rk > 0),
pk AS (SELECT r.*, c.cell, c.rk FROM reads r JOIN cells c USING (barcode)),
pl AS (SELECT cell, min(rk) AS place FROM cells WHERE barcode = cell GROUP BY cell),
pc AS (SELECT cell, R1k, P, C, O, F, G, S, count(*) AS n FROM pk WHERE gene_class = '16s' GROUP BY ALL)"""


def _consensus_sql() -> str:
    out = ", st0 AS (SELECT cell, sum(n) AS total, " + ", ".join(f"CAST(NULL AS VARCHAR) AS a_{c}" for c in COLS) + ", 1.0::DOUBLE AS conf, true AS going, 0 AS depth FROM pc GROUP BY cell)"
    for k, c in enumerate(COLS):
        fit = " AND ".join([f"(p.{e} IS NULL OR p.{e} = s.a_{e})" for e in COLS[:k]] or ["true"])
        own = f"p.{COLS[k - 1]} = s.a_{COLS[k - 1]}" if k else "true"
        out += f""", fit{k} AS (SELECT p.cell, p.{c} AS v, p.n FROM pc p JOIN st{k} s USING (cell) WHERE s.going AND {fit}),
tot{k} AS (SELECT cell, sum(n) AS total, coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS none FROM fit{k} GROUP BY cell),
cand{k} AS (SELECT DISTINCT p.cell, p.{c} AS v FROM pc p JOIN st{k} s USING (cell) WHERE s.going AND {own}),
sc{k} AS (SELECT c.cell, c.v, CASE WHEN c.v IS NULL THEN t.none * ln(0.9) + (t.total - t.none) * ln(0.01)
  ELSE m.n * ln(0.9) + t.none * ln(0.09) + (t.total - m.n - t.none) * ln(0.01) END AS ll
  FROM cand{k} c JOIN tot{k} t USING (cell), LATERAL (SELECT coalesce(sum(n), 0) AS n FROM fit{k} f WHERE f.cell = c.cell AND f.v = c.v) m),
top{k} AS (SELECT s.cell, arg_max(v, ll) FILTER (WHERE ll = mx) AS v, bool_or(v IS NULL AND ll = mx) AS none_best, 1 / sum(exp(ll - mx)) AS share, count(v) AS real
  FROM (SELECT *, max(ll) OVER (PARTITION BY cell) AS mx FROM sc{k}) s GROUP BY s.cell),
st{k + 1} AS (SELECT s.cell, s.total, {", ".join(f"CASE WHEN ok THEN v END AS a_{e}" if e == c else f"a_{e}" for e in COLS)}, CASE WHEN ok THEN share ELSE conf END AS conf, ok AS going, CASE WHEN ok THEN {k + 1} ELSE depth END AS depth
  FROM (SELECT s.*, t.v, t.share, coalesce(s.going AND t.real > 0 AND t.share >= 0.95 AND NOT t.none_best, false) AS ok FROM st{k} s LEFT JOIN top{k} t USING (cell)) s)"""
    pick = lambda p: "CASE greatest(s.depth - 1, 0) " + " ".join(f"WHEN {k} THEN {p}{c}" for k, c in enumerate(COLS)) + " END"
    out += f""", deep AS (SELECT s.cell, s.total, {pick('s.a_')} AS acc, {pick('p.')} AS v, p.n FROM pc p JOIN st7 s USING (cell)),
dn AS (SELECT cell, any_value(total) AS total, any_value(acc) AS acc, v, sum(n) AS n FROM deep WHERE v IS NOT NULL GROUP BY cell, v),
sp AS (SELECT cell, coalesce(sum(n) FILTER (WHERE v = acc), 0) AS match, coalesce(sum(n) FILTER (WHERE v IS DISTINCT FROM acc AND (n < 2 OR n / total < 0.05)), 0) AS noise,
  coalesce(sum(n) FILTER (WHERE v IS DISTINCT FROM acc AND NOT (n < 2 OR n / total < 0.05)), 0) AS contam FROM dn GROUP BY cell),
su AS (SELECT s.cell, CAST(s.total AS BIGINT) AS total, CAST(coalesce(p.noise, 0) AS BIGINT) AS noise, {", ".join(f"s.a_{c}" for c in COLS)}, s.conf,
  (1 + coalesce(p.contam, 0)) / (10.0 + coalesce(p.contam, 0) + coalesce(p.match, 0) + coalesce(p.noise, 0)) AS contamination FROM st7 s LEFT JOIN sp p USING (cell))"""
    return out


def _lineage_sql(prefix: str = "a_") -> str:
    return "concat(" + ", ' | ', ".join(f"'{code} - ', coalesce({prefix}{c}, 'None')" for code, c in zip(CODES, COLS)) + ")"


_su = _cl + _consensus_sql()
_s1 = _su + f""", s1 AS (SELECT *, {_lineage_sql()} AS lineage FROM su WHERE total > 5 AND contamination < 0.1 AND coalesce({", ".join(f"a_{c}" for c in COLS[1:])}) IS NOT NULL)"""
_sz = _s1 + ", sz AS (SELECT * FROM s1 QUALIFY count(*) OVER (PARTITION BY lineage) >= 2)"
_core = """, co AS (SELECT p.cell, substr(r1, 31, 90) AS c1, substr(r2, 71, 50) AS c2, count(*) AS n, min(p.rk * 1000000000 + read_index) AS first
  FROM pk p JOIN sz USING (cell) WHERE gene_class = '16s' AND length(r1) >= 120 AND length(r2) >= 120 GROUP BY ALL),
cr AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, first) AS k FROM co)"""


def _shift_sql(a: str, b: str, k: int) -> str:
    tries = []
    for s in range(-k, k + 1):
        x, y = (f"substr({a}, {s + 1})", b) if s >= 0 else (a, f"substr({b}, {1 - s})")
        tries.append(f"hamming(substr({x}, 1, least(length({x}), length({y}))::INT), substr({y}, 1, least(length({x}), length({y}))::INT))")
    return "least(" + ", ".join(tries) + ")"


def _far_sql(a: str, b: str, k: int) -> str:
    return f"greatest({_shift_sql(a + '.c1', b + '.c1', k)}, {_shift_sql(a + '.c2', b + '.c2', k)})"


# the fold of a cell's cores, one core a step, all cells at once
_asv = _sz + _core + f""", tot AS (SELECT cell, sum(n) AS total, count(*) AS uniq, greatest(2, CAST(floor(0.05 * sum(n)) AS BIGINT)) AS gate FROM cr GROUP BY cell),
fo AS (
 SELECT r.cell, 1::BIGINT AS k, [{{'c1': r.c1, 'c2': r.c2}}] AS mem, r.n::BIGINT AS final, 0::BIGINT AS coex, 0::BIGINT AS sec, 0::BIGINT AS wide FROM cr r WHERE k = 1
 UNION ALL
 SELECT y.cell, y.k, CASE WHEN y.clash IS NULL THEN list_append(y.mem, {{'c1': y.c1, 'c2': y.c2}}) ELSE y.mem END,
  CASE WHEN y.clash IS NULL THEN y.final + y.n ELSE y.final END, CASE WHEN y.clash IS NULL THEN y.coex + y.n ELSE y.coex END,
  CASE WHEN y.clash IS NOT NULL AND y.n >= y.gate THEN y.sec + y.n ELSE y.sec END,
  CASE WHEN y.clash IS NULL THEN greatest(y.wide, y.d) WHEN y.n >= y.gate THEN greatest(y.wide, y.clash) ELSE y.wide END
 FROM (SELECT x.*, t.gate, CASE WHEN x.d > 3 THEN x.d ELSE list_filter(x.ds, lambda e: e > 3)[1] END AS clash
   FROM (SELECT f.cell, r.k, f.mem, f.final, f.coex, f.sec, f.wide, r.n::BIGINT AS n, r.c1, r.c2,
      list_transform(f.mem, lambda m: {_far_sql('r', 'm', 3)}::BIGINT) AS ds, list_transform(f.mem, lambda m: {_far_sql('r', 'm', 3)}::BIGINT)[1] AS d
     FROM fo f JOIN cr r ON r.cell = f.cell AND r.k = f.k + 1) x JOIN tot t USING (cell)) y),
ty AS (SELECT z.cell, z.lineage, z.a_P, z.total AS total_16s, z.noise, z.conf, z.contamination, CAST(coalesce(t.total, 0) AS BIGINT) AS reads_used, CAST(coalesce(t.uniq, 0) AS BIGINT) AS raw_unique, d.c1, d.c2, CAST(coalesce(d.n, 0) AS BIGINT) AS dominant_reads,
  coalesce(f.coex, 0) AS coexisting, coalesce(f.sec, 0) AS secondary, coalesce(f.final, 0) AS final_reads, coalesce(f.wide, 0) AS max_distance,
  CASE WHEN t.total IS NULL THEN 'no_usable_reads' WHEN t.total < 5 THEN 'low_depth' WHEN f.sec = 0 THEN 'single_ASV' WHEN f.sec / (f.final + f.sec) >= 0.1 THEN 'mixed_ASV' ELSE 'corrupted_single_ASV' END AS status
 FROM sz z LEFT JOIN tot t USING (cell) LEFT JOIN cr d ON d.cell = z.cell AND d.k = 1 LEFT JOIN fo f ON f.cell = z.cell AND f.k = t.uniq)"""
_reg = _asv + """, rg AS (SELECT c1, c2, count(*) AS cells, row_number() OVER (ORDER BY count(*) DESC, min(place), c1) AS asv_no FROM ty JOIN pl USING (cell) WHERE status IN ('single_ASV', 'corrupted_single_ASV') GROUP BY c1, c2),
ai AS (SELECT t.*, CASE WHEN asv_no IS NOT NULL THEN concat('ASV_', asv_no) END AS asv_id FROM ty t LEFT JOIN rg USING (c1, c2)),
ok AS (SELECT * FROM ai WHERE status NOT IN ('mixed_ASV', 'low_depth', 'no_usable_reads')),
ph AS (SELECT asv_id, a_P, count(*) AS n, sum(count(*)) OVER (PARTITION BY asv_id) AS support, row_number() OVER (PARTITION BY asv_id ORDER BY count(*) DESC, a_P NULLS LAST) AS k FROM ok GROUP BY asv_id, a_P),
ju AS (SELECT o.*, coalesce(p.support >= 3 AND p.n / p.support >= 0.99 AND p.a_P IS NOT NULL AND o.a_P IS NOT NULL AND o.a_P <> p.a_P, false) AS conflict FROM ok o LEFT JOIN ph p ON p.asv_id = o.asv_id AND p.k = 1),
al AS (SELECT * FROM ju WHERE NOT conflict)"""
_bg = _reg + """, tc AS (SELECT p.cell, p.target, count(*) AS n, any_value(a.total_16s) AS s16 FROM pk p JOIN al a USING (cell) WHERE gene_class = 'target' GROUP BY ALL),
rt AS (SELECT target, sum(n) / (SELECT sum(total_16s) FROM al) AS r FROM tc GROUP BY target),
pv AS (SELECT t.*, s16 * r AS rate, CASE WHEN s16 * r <= 0 THEN 0.0 ELSE 1 - list_sum(list_transform(range(n), lambda m: exp(-(s16 * r)) * pow(s16 * r, m) / factorial(m::INT))) END AS p FROM tc t JOIN rt USING (target)),
bg AS (SELECT *, CASE WHEN p < 0.5 THEN n ELSE 0 END AS filtered FROM pv)"""
_seq = _bg + """, tq0 AS (SELECT p.cell, p.target, substr(r1, 31, 90) AS c1, substr(r2, 71, 50) AS c2, count(*) AS n, min(p.rk * 1000000000 + read_index) AS first FROM pk p JOIN al USING (cell) WHERE gene_class = 'target' GROUP BY ALL),
tr AS (SELECT target, c1, c2, row_number() OVER (PARTITION BY target ORDER BY sum(n) DESC, min(first), c1) AS k FROM tq0 GROUP BY target, c1, c2)""" 
_fa = f"greatest({_shift_sql('r.c1', 'm.c1', 2)}, {_shift_sql('r.c2', 'm.c2', 2)})"
_seq += f""", cq AS (
 SELECT target, k, [{{'c1': c1, 'c2': c2}}] AS doms, c1, c2, c1 AS d1, c2 AS d2 FROM tr WHERE k = 1
 UNION ALL
 SELECT y.target, y.k, CASE WHEN y.hit THEN y.doms ELSE list_append(y.doms, {{'c1': y.c1, 'c2': y.c2}}) END, y.c1, y.c2, CASE WHEN y.hit THEN y.doms[1].c1 ELSE y.c1 END, CASE WHEN y.hit THEN y.doms[1].c2 ELSE y.c2 END
 FROM (SELECT q.target, r.k, q.doms, r.c1, r.c2, len(list_filter(q.doms, lambda m: {_fa} > 0)) = 0 AS hit FROM cq q JOIN tr r ON r.target = q.target AND r.k = q.k + 1) y),
tq AS (SELECT t.cell, t.target, q.d1, q.d2, sum(t.n) AS n FROM tq0 t JOIN cq q USING (target, c1, c2) GROUP BY ALL),
cc AS (SELECT *, sum(n) OVER w AS total, max(n) OVER w AS mx, 1 / sum(exp((n - mx0) * (ln(0.9) - ln(0.01)))) OVER w AS share FROM (SELECT *, max(n) OVER (PARTITION BY cell, target) AS mx0 FROM tq) WINDOW w AS (PARTITION BY cell, target)),
ca AS (SELECT cell, target, CAST(any_value(total) AS BIGINT) AS total, any_value(share) AS share, arg_max(d1, n) AS d1, arg_max(d2, n) AS d2, any_value(share) >= 0.95 AS known,
  CAST(coalesce(sum(n) FILTER (WHERE n < mx AND (n < 2 OR n / total < 0.05)), 0) AS BIGINT) AS noise, coalesce(sum(n) FILTER (WHERE n < mx AND NOT (n < 2 OR n / total < 0.05)), 0) AS contam FROM cc GROUP BY cell, target),
nm AS (SELECT target, d1, d2, count(*) AS cells, row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, min(place), d1) AS seq_no FROM ca JOIN pl USING (cell) WHERE known GROUP BY target, d1, d2)"""


def _with(parts: str, select: str) -> str:
    return f"WITH RECURSIVE {parts}\n{select}"


# ---- read level
@query(_with(_qc, "SELECT coalesce(qc_reason, 'passed') AS reason, count(*) AS n FROM qc GROUP BY ALL"))
def q01_read_qc_reasons(spark, sf_dir):
    return demux.with_qc(_pairs(spark, sf_dir)).groupBy(F.coalesce("qc_reason", F.lit("passed")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(_with(_qc, "SELECT read_index FROM qc WHERE qc_reason IS NULL"))
def q02_passing_reads(spark, sf_dir):
    return demux.with_qc(_pairs(spark, sf_dir)).where("qc_reason is null").select("read_index")


@query(_with(_reads, f"SELECT read_index, CAST({_start_sql('fq1', FWD)} AS INT) AS primer_start FROM reads"))
def q03_primer_start(spark, sf_dir):
    return _pairs(spark, sf_dir).select("read_index", S.primer_start(F.col("r1_seq"), FWD).alias("primer_start"))


@query(_with(_reads, _expand(f"SELECT read_index, coalesce({_match_sql('fq2', PANEL[1][3], 42)}, false) AS rev_match, coalesce({_match_sql('fq1', PANEL[1][2], 0)}, false) AS fwd_match FROM reads")))
def q04_primer_match_fuzzy(spark, sf_dir):
    return _pairs(spark, sf_dir).select("read_index", S.primer_matches(F.col("r2_seq"), PANEL[1][3], 4, 4, 42).alias("rev_match"), S.primer_matches(F.col("r1_seq"), PANEL[1][2], 4, 4).alias("fwd_match"))


_gene = "coalesce(" + ", ".join([f"CASE WHEN substr(fq2, 43, {len(r)}) = '{r}' AND substr(fq1, 1, {len(f)}) = '{f}' THEN {k} END" for k, _, f, r, _ in PANEL] + [f"CASE WHEN {_match_sql('fq2', r, 42)} AND {_match_sql('fq1', f, 0)} THEN {k} END" for k, _, f, r, _ in PANEL]) + ")"


@query(_with(_reads, _expand(f"SELECT read_index, CAST({_gene} AS INT) AS panel_index FROM reads")))
def q05_demux_assignment(spark, sf_dir):
    return _pairs(spark, sf_dir).select("read_index", demux.gene_of(F.col("r1_seq"), F.col("r2_seq"), PANEL).alias("panel_index"))


@query(_with(_reads, "SELECT gene_class, count(*) AS n FROM reads GROUP BY ALL"))
def q06_class_balance(spark, sf_dir):
    return surrogate.reads(spark, sf_dir).groupBy("gene_class").agg(F.count(F.lit(1)).alias("n"))


_starts = _reads + _expand(f", sg AS (SELECT CASE WHEN coalesce({_match_sql('fq2', REV, 42)}, false) THEN {_start_sql('fq1', FWD)} END AS st FROM reads)")


@query(_with(_starts, "SELECT CAST(g.s AS INT) AS start, count(st) AS n FROM range(10) AS g(s) LEFT JOIN sg ON st = g.s GROUP BY ALL"))
def q07_stagger_histogram(spark, sf_dir):
    return demux.stagger_counts(demux.place_16s(_pairs(spark, sf_dir), FWD, REV))


@query(_with(_reads, f"SELECT read_index, substr(fq1, {len(FWD) + 1}) AS trimmed_r1, substr(fq2, {42 + len(REV) + 1}) AS trimmed_r2, CASE WHEN length(fq1) >= 124 AND length(fq2) >= 120 THEN substr(fq1, 35, 90) END AS core_r1, CASE WHEN length(fq1) >= 124 AND length(fq2) >= 120 THEN substr(fq2, 71, 50) END AS core_r2 FROM reads"))
def q08_trim_core(spark, sf_dir):
    core = S.core(F.col("r1_seq"), F.col("r2_seq"), start=F.lit(4))
    return _pairs(spark, sf_dir).select("read_index", S.after(F.col("r1_seq"), 0, FWD).alias("trimmed_r1"), S.after(F.col("r2_seq"), 42, REV).alias("trimmed_r2"), core["r1"].alias("core_r1"), core["r2"].alias("core_r2"))


@query(_with(_reads, "SELECT read_index, reverse(translate(r2, 'ACGT', 'TGCA')) AS reverse_complement, right(r2, 60) AS last_bases FROM reads"))
def q09_revcomp(spark, sf_dir):
    return surrogate.reads(spark, sf_dir).select("read_index", S.reverse_complement(F.col("r2")).alias("reverse_complement"), S.last_bases(F.col("r2")).alias("last_bases"))


_strains = _reads + ", one AS (SELECT strain, any_value(r1) FILTER (WHERE read_index % 7 <> 0) AS c1, any_value(r2) AS c2 FROM reads GROUP BY strain)"


@query(_with(_strains, f"SELECT a.strain AS a, b.strain AS b, CAST({_far_sql('a', 'b', 3)} AS INT) AS distance FROM one a JOIN one b ON a.strain < b.strain"))
def q10_semi_global_distance(spark, sf_dir):
    one = surrogate.reads(spark, sf_dir).where("read_index % 7 <> 0").groupBy("strain").agg(F.struct(F.min("r1").alias("r1"), F.min("r2").alias("r2")).alias("core"))
    a, b = one.toDF("a", "x"), one.toDF("b", "y")
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", S.paired_semi_global(F.col("x"), F.col("y"), 3).alias("distance"))


# ---- barcodes
@query(_with(_bc, "SELECT barcode, n, rk AS barcode_rank FROM bc"))
def q11_barcode_counts_ranked(spark, sf_dir):
    counts = barcodes.barcode_counts(surrogate.packets(spark, sf_dir))
    return order.numbered(counts, [F.desc("n"), "first"], "barcode_rank").select("barcode", "n", "barcode_rank")


@query(_with(_bc, "SELECT a.barcode AS earlier, b.barcode AS later FROM bc a JOIN bc b ON a.rk < b.rk AND (substr(a.barcode, 2) = substr(b.barcode, 1, 5) OR substr(b.barcode, 2) = substr(a.barcode, 1, 5))"))
def q12_barcode_shift_pairs(spark, sf_dir):
    return barcodes.shift_edges(barcodes.barcode_counts(surrogate.packets(spark, sf_dir))).select("earlier", "later").distinct()


@query(_with(_cl, "SELECT barcode, cell FROM cells"))
def q13_barcode_clusters(spark, sf_dir):
    return Steps(spark, sf_dir).packets().select("barcode", "cell").distinct()


# ---- taxonomy
_TAXA = [(str(10 + k), "G", f"G{k}", ("Bacteria", f"P{k % 3}", f"C{k % 3}", f"O{k % 6}", f"F{k % 6}", f"G{k}", None)) for k in range(12)]
_label = surrogate.LABEL


@query(_with(_reads, f"""SELECT read_id, l <> '0' AS classifiable, CASE WHEN known THEN 'Bacteria' END AS domain, CASE WHEN known THEN concat('P', strain % 3) END AS phylum, CASE WHEN known THEN concat('G', strain) END AS genus
 FROM (SELECT *, {_label} AS l, {_label} NOT IN ('0', '1', 'g__missing') AS known FROM reads WHERE gene_class = '16s')"""))
def q14_taxonomy_path_join(spark, sf_dir):
    from tessera.sources.tables import TAXA

    own = surrogate.reads(spark, sf_dir).where("gene_class = '16s'")
    labels = own.select("read_id", F.expr(_label).alias("label"))
    out = demux.classify(own.select("read_id", "gene_class"), labels, spark.createDataFrame(_TAXA, TAXA))
    return out.select("read_id", "classifiable", F.col("path.R1").alias("domain"), F.col("path.P").alias("phylum"), F.col("path.G").alias("genus"))


@query(_with(_su, "SELECT cell, " + ", ".join(f"a_{c} AS {n}" for c, n in zip(COLS, S.RANKS.values())) + ", round(conf, 9) AS confidence FROM su"))
def q15_rank_consensus(spark, sf_dir):
    return Steps(spark, sf_dir).summary().select("cell", *[F.col("path")[c].alias(n) for c, n in S.RANKS.items()], r9("confidence").alias("confidence"))


@query(_with(_su, "SELECT cell, total AS total_16s, noise, round(contamination, 9) AS contamination FROM su"))
def q16_contamination(spark, sf_dir):
    return Steps(spark, sf_dir).summary().select("cell", "total_16s", "noise", r9("contamination").alias("contamination"))


@query(_with(_su, f"SELECT s.cell, {_lineage_sql()} AS lineage, total AS total_16s, noise, round(conf, 9) AS confidence, round(contamination, 9) AS contamination, coalesce(t1, 0) AS t1, coalesce(t2, 0) AS t2 FROM su s LEFT JOIN (SELECT cell, count(*) FILTER (WHERE target = 'T1') AS t1, count(*) FILTER (WHERE target = 'T2') AS t2 FROM pk GROUP BY cell) USING (cell)"))
def q17_cell_summary(spark, sf_dir):
    s = Steps(spark, sf_dir)
    wide = s.counts().groupBy("cell").pivot("target", TARGETS).agg(F.sum("n"))
    out = s.summary().join(wide, "cell", "left").fillna(0, TARGETS)
    return out.select("cell", S.lineage(F.col("path")).alias("lineage"), "total_16s", "noise", r9("confidence").alias("confidence"), r9("contamination").alias("contamination"), F.col("T1").alias("t1"), F.col("T2").alias("t2"))


@query(_with(_s1, "SELECT cell, total AS total_16s, lineage FROM s1"))
def q18_stage1_filter(spark, sf_dir):
    return Steps(spark, sf_dir).stage1().select("cell", "total_16s", S.lineage(F.col("path")).alias("lineage"))


@query(_with(_sz, "SELECT cell, lineage FROM sz"))
def q19_min_cells_per_taxon(spark, sf_dir):
    return Steps(spark, sf_dir).sized().select("cell", S.lineage(F.col("path")).alias("lineage"))


@query(_with(_reads, f"SELECT read_index, {_lineage_sql('')} AS lineage, {_lineage_sql('')} AS again, coalesce(S, G) AS most_specific FROM reads"))
def q20_lineage_string(spark, sf_dir):
    own = surrogate.packets(spark, sf_dir).withColumn("lineage", S.lineage(F.col("path")))
    return own.select("read_index", "lineage", S.lineage(S.parse_lineage(F.col("lineage"))).alias("again"), S.most_specific(F.col("path")).alias("most_specific"))


# ---- variants
@query(_with(_sz + _core, "SELECT cell, c1 AS r1, c2 AS r2, n FROM cr WHERE k = 1"))
def q21_asv_dominant(spark, sf_dir):
    s = Steps(spark, sf_dir)
    top = s.cores().groupBy("cell").agg(F.min_by(F.struct("core", "n"), F.struct((-F.col("n")).alias("a"), F.col("first").alias("b"))).alias("t"))
    return top.select("cell", "t.core.r1", "t.core.r2", "t.n")


_numbers = ["reads_used", "raw_unique", "dominant_reads", "coexisting", "secondary", "final_reads", "max_distance"]


@query(_with(_asv, f"SELECT cell, {', '.join(_numbers)}, status FROM ty"))
def q22_asv_summary(spark, sf_dir):
    return Steps(spark, sf_dir).typed().select("cell", *_numbers, "status")


@query(_with(_reg, "SELECT concat('ASV_', asv_no) AS asv_id, cells, c1 AS r1, c2 AS r2 FROM rg"))
def q23_asv_registry(spark, sf_dir):
    return Steps(spark, sf_dir).asvs().select("asv_id", "cells", "core.r1", "core.r2")


@query(_with(_reg, "SELECT cell, asv_id, status, status NOT IN ('mixed_ASV', 'low_depth', 'no_usable_reads') AS kept FROM ai"))
def q24_asv_status_filter(spark, sf_dir):
    return Steps(spark, sf_dir).judged().select("cell", "asv_id", "status", (~F.col("status").isin(*variants.REMOVED)).alias("kept"))


@query(_with(_reg, "SELECT cell, asv_id, a_P AS phylum, conflict FROM ju"))
def q25_asv_phylum_conflict(spark, sf_dir):
    return Steps(spark, sf_dir).judged().where("stage is null or stage = 'asv_taxonomy_conflict'").select("cell", "asv_id", F.col("path.P").alias("phylum"), "conflict")


# ---- targets
@query(_with(_bg, "SELECT cell, target, n, round(rate, 9) AS rate, round(p, 9) AS p FROM pv"))
def q26_poisson_pvalue(spark, sf_dir):
    return Steps(spark, sf_dir).tested().select("cell", "target", "n", r9("rate").alias("rate"), r9("p").alias("p"))


@query(_with(_bg, "SELECT cell, target, n, CAST(filtered AS BIGINT) AS filtered FROM bg"))
def q27_target_background_filter(spark, sf_dir):
    return Steps(spark, sf_dir).tested().select("cell", "target", "n", "filtered")


_st = "SELECT v.target, count(b.n) AS original, count(b.n) FILTER (WHERE filtered = 0) AS filtered_out, count(b.n) FILTER (WHERE filtered > 0) AS remaining, round(CASE WHEN count(b.n) > 0 THEN count(b.n) FILTER (WHERE filtered > 0) / count(b.n) * 100 ELSE 0 END, 9) AS retention FROM (VALUES ('T1'), ('T2')) v(target) LEFT JOIN bg b USING (target) GROUP BY ALL"


@query(_with(_bg, _st))
def q28_target_filter_stats(spark, sf_dir):
    return cells.background_stats(Steps(spark, sf_dir).tested(), TARGETS).select("target", "original", "filtered_out", "remaining", r9("retention").alias("retention"))


@query(_with(_seq, "SELECT cell, target, CASE WHEN known THEN d1 END AS r1, CASE WHEN known THEN round(share, 9) END AS confidence, CASE WHEN known THEN round((1 + contam) / (10.0 + total), 9) END AS contamination, total, CASE WHEN known THEN noise ELSE 0 END AS noise FROM ca"))
def q29_seq_consensus(spark, sf_dir):
    return Steps(spark, sf_dir).calls().select("cell", "target", "core.r1", r9("confidence").alias("confidence"), r9("contamination").alias("contamination"), "total", "noise")


@query(_with(_seq, "SELECT target, c1 AS r1, c2 AS r2, d1 AS dominant_r1, d2 AS dominant_r2 FROM cq"))
def q30_seq_clusters(spark, sf_dir):
    return Steps(spark, sf_dir).clusters().select("target", "core.r1", "core.r2", F.col("dominant.r1").alias("dominant_r1"), F.col("dominant.r2").alias("dominant_r2"))


@query(_with(_seq, "SELECT concat(target, '_seq_', seq_no) AS sequence_id, cells, d1 AS r1 FROM nm"))
def q31_seq_naming(spark, sf_dir):
    return Steps(spark, sf_dir).names().select("sequence_id", "cells", "core.r1")


@query()
def q32_seq_denoise(spark, sf_dir):
    return Steps(spark, sf_dir).names().select("sequence_id", "cells", "retained")


# sequences are kept by their rank from here on: SQL can't state the fit of q32
_ns = _seq + """, nk AS (SELECT *, concat(target, '_seq_', seq_no) AS sequence_id, seq_no <= 2 AS retained FROM nm),
an AS (SELECT ca.*, nk.sequence_id FROM ca LEFT JOIN nk ON ca.known AND nk.retained AND nk.target = ca.target AND nk.d1 = ca.d1 AND nk.d2 = ca.d2),
asg AS (SELECT b.cell, b.target, b.n, CAST(b.filtered AS BIGINT) AS filtered, CASE WHEN b.filtered = 0 THEN 'filtered_out' WHEN b.target <> 'T1' THEN 'detected' WHEN an.sequence_id IS NULL THEN 'sequence_unresolved' ELSE 'sequence_cluster' END AS kind, an.sequence_id AS sid
  FROM bg b LEFT JOIN an ON an.cell = b.cell AND an.target = b.target)"""


@query(_with(_ns, "SELECT cell, target, coalesce(sequence_id, concat(target, '_parent')) AS assignment FROM an"))
def q33_parent_fallback(spark, sf_dir):
    s = Steps(spark, sf_dir)
    found = s.calls().join(s.ranked_names().where("retained").select("target", "core", "sequence_id"), ["target", "core"], "left")
    return found.select("cell", "target", F.coalesce("sequence_id", F.concat("target", F.lit("_parent"))).alias("assignment"))


def _repeats_sql(name: str, table: str, key: str, text: str) -> str:
    """Tables that find tandem repeats greedily from the left: name (key, i, span, size) has a row for each place that is looked at, span 0 where none begins."""
    common = "coalesce(list_position(list_transform(range(0, length(s) - i - z), lambda k: substr(s, CAST(i + k + 1 AS INT), 1) <> substr(s, CAST(i + z + k + 1 AS INT), 1)), true) - 1, length(s) - i - z)"
    best = f"coalesce(list_max(list_transform(range(1, (length(s) - i) // 2 + 1), lambda z: CASE WHEN {common} >= z THEN z * (1 + {common} // z) * 1000 + 999 - z ELSE 0 END)), 0)"
    return f"""{name} AS (
 SELECT {key} AS key, {text} AS s, 0::BIGINT AS i, NULL::BIGINT AS v FROM {table}
 UNION ALL
 SELECT key, s, CASE WHEN v IS NULL THEN i WHEN v > 0 THEN i + v // 1000 ELSE i + 1 END, CASE WHEN v IS NULL THEN {best} END FROM {name} WHERE i < length(s))"""


_rep = lambda name, table, key, text: _repeats_sql(name, table, key, text) + f""", {name}f AS (SELECT key, i AS start, i + v // 1000 AS stop, v // 1000 AS span, 999 - v % 1000 AS size, substr(s, CAST(i + 1 AS INT), CAST(999 - v % 1000 AS INT)) AS motif FROM {name} WHERE v > 0)"""


@query(_with(_reads + ", st1 AS (SELECT strain, substr(min(r1), 31, 90) AS t FROM reads GROUP BY strain), " + _rep("rp", "st1", "strain", "t"), 'SELECT key AS strain, motif, CAST(span // size AS INT) AS repeat_count, CAST(start AS INT) AS start, CAST(stop AS INT) AS "end" FROM rpf'))
def q34_tandem_repeats(spark, sf_dir):
    one = surrogate.reads(spark, sf_dir).groupBy("strain").agg(F.min("r1").alias("r1"))
    return one.select("strain", F.explode(sequences.find_repeats(F.substring("r1", 31, 90))).alias("r")).select("strain", "r.*")


_phase = ", t1 AS (SELECT sequence_id, concat(d1, reverse(translate(d2, 'ACGT', 'TGCA'))) AS t FROM nk WHERE target = 'T1'), " + _rep("rq", "t1", "sequence_id", "t") + ", pb AS (SELECT key, arg_max({'motif': motif, 'times': span // size, 'start': start, 'stop': stop}, span * 1000 - start) AS b FROM rqf GROUP BY key)"


@query(_with(_ns + _phase, """SELECT 'T1' AS target, sequence_id, 'ssr' AS mode, CASE WHEN b IS NULL THEN 'no_ssr_detected' ELSE 'ssr_detected' END AS call, b.motif AS motif, CAST(b.times AS INT) AS repeat_count, CAST(b.start AS INT) AS start, CAST(b.stop AS INT) AS "end", CAST(NULL AS DOUBLE) AS direct_similarity, 'tandem_repeat_scan' AS evidence
 FROM t1 LEFT JOIN pb ON pb.key = t1.sequence_id"""))
def q35_phase_calls(spark, sf_dir):
    return sequences.phase_calls(Steps(spark, sf_dir).names(), surrogate.panel(spark).select("target", "mode"))


_ref = "rf AS (SELECT concat('ref', strain) AS title, concat('TTGCA', substr(min(r1) FILTER (WHERE read_index % 7 <> 0), 1, 160), 'GGATC', CASE WHEN strain % 2 = 0 THEN reverse(translate(min(r2), 'ACGT', 'TGCA')) ELSE min(r2) END) AS seq FROM reads WHERE strain % 3 <> 1 GROUP BY strain)"


@query(_with(_seq + ", " + _ref, """SELECT concat(target, '_seq_', seq_no) AS sequence_id, title AS subject, CAST(s1 AS INT) AS r1_start, CAST(s1 + length(d1) - 1 AS INT) AS r1_end, CAST(s2 AS INT) AS r2_start, CAST(s2 + length(d2) - 1 AS INT) AS r2_end FROM (
 SELECT *, CASE WHEN instr(seq, d1) > 0 THEN instr(seq, d1) WHEN instr(seq, reverse(translate(d1, 'ACGT', 'TGCA'))) > 0 THEN instr(seq, reverse(translate(d1, 'ACGT', 'TGCA'))) END AS s1,
  CASE WHEN instr(seq, d2) > 0 THEN instr(seq, d2) WHEN instr(seq, reverse(translate(d2, 'ACGT', 'TGCA'))) > 0 THEN instr(seq, reverse(translate(d2, 'ACGT', 'TGCA'))) END AS s2 FROM nm CROSS JOIN rf) WHERE s1 IS NOT NULL AND s2 IS NOT NULL"""))
def q36_reference_exact_match(spark, sf_dir):
    return sequences.reference_matches(Steps(spark, sf_dir).names(), _reference(spark, sf_dir)).drop("percent_identity")


def _reference(spark, sf_dir) -> DataFrame:
    own = surrogate.reads(spark, sf_dir).where("strain % 3 <> 1").groupBy("strain").agg(F.min(F.when(F.col("read_index") % 7 != 0, F.col("r1"))).alias("r1"), F.min("r2").alias("r2"))
    mate = F.when(F.col("strain") % 2 == 0, S.reverse_complement(F.col("r2"))).otherwise(F.col("r2"))
    name = F.concat(F.lit("ref"), F.col("strain").cast("string"))
    return own.select(name.alias("name"), name.alias("title"), F.concat(F.lit("TTGCA"), F.substring("r1", 1, 160), F.lit("GGATC"), mate).alias("seq"))


# ---- results
_ab = _ns + ", ab AS (SELECT asv_id, count(*) AS n, count(*) / (SELECT count(*) FROM al) AS share, count(*) >= 2 AND count(*) / (SELECT count(*) FROM al) >= 0.005 AS passed FROM al GROUP BY asv_id)"


@query(_with(_ab, "SELECT asv_id, n AS cells, round(share, 9) AS share, passed FROM ab"))
def q37_abundance_filter(spark, sf_dir):
    return variants.abundance(Steps(spark, sf_dir).alive(), PARAMS.variants).select("asv_id", "cells", r9("share").alias("share"), "passed")


def _candidates(spark, sf_dir) -> DataFrame:
    s = Steps(spark, sf_dir)
    panel = surrogate.panel(spark)
    dead = s.counts().join(s.judged().where("stage is not null").select("cell"), "cell", "left_semi")
    make = lambda: results.candidate_cells(s.judged(), results.nested_targets(s.assigned(), panel, s.calls().where("target = 'T1'")), results.not_evaluated(dead, panel), variants.abundance(s.alive(), s.p.variants), RUN_ID)
    return surrogate.kept(spark, sf_dir, "candidates", make)


def _final(spark, sf_dir) -> DataFrame:
    return results.final_cells(_candidates(spark, sf_dir))


def _final_asvs(spark, sf_dir) -> DataFrame:
    return results.final_asvs(_final(spark, sf_dir), Steps(spark, sf_dir).asvs(), RUN_ID)


_ca = _ab + """, cd AS (SELECT i.cell, i.asv_id, CASE WHEN a.cell IS NULL AND j.cell IS NULL THEN 'asv_status_quality' WHEN a.cell IS NULL THEN 'asv_taxonomy_conflict' WHEN b.passed THEN 'final' ELSE 'asv_abundance' END AS stage,
  CASE WHEN a.cell IS NULL AND j.cell IS NULL THEN i.status WHEN a.cell IS NULL THEN 'asv_phylum_conflict' WHEN b.passed THEN NULL ELSE 'low_asv_support' END AS reason
  FROM ai i LEFT JOIN ju j USING (cell) LEFT JOIN al a ON a.cell = i.cell LEFT JOIN ab b ON b.asv_id = i.asv_id),
fc AS (SELECT i.* FROM ai i JOIN cd ON cd.cell = i.cell AND cd.stage = 'final')"""


@query(_with(_ca, "SELECT cell AS cell_barcode, stage = 'final' AS passed, stage, reason FROM cd"))
def q38_final_filter_provenance(spark, sf_dir):
    return _candidates(spark, sf_dir).select("cell_barcode", "final_filter.*")


@query(_with(_ns, "SELECT cell, target, n, filtered, kind AS assignment_type, CASE WHEN kind = 'sequence_cluster' THEN sid END AS sequence_id FROM asg"))
def q39_assignment_type(spark, sf_dir):
    return Steps(spark, sf_dir).assigned()


@query(_with(_ca, "SELECT cell AS cell_barcode, asv_id, lineage, total_16s AS total_16s_reads, noise AS technical_noise_reads, reads_used, max_distance AS max_internal_distance, (SELECT count(*) FROM bg b WHERE b.cell = fc.cell) AS n_targets FROM fc"))
def q40_cells_nested(spark, sf_dir):
    c = _final(spark, sf_dir)
    ranks = F.col("taxonomy.ranks")
    path = F.concat_ws(" | ", *[F.concat(F.lit(f"{k} - "), F.coalesce(ranks[n], F.lit("None"))) for k, n in S.RANKS.items()])
    return c.select("cell_barcode", "asv.asv_id", path.alias("lineage"), "taxonomy_evidence.total_16s_reads", "taxonomy_evidence.technical_noise_reads", "asv.reads_used", "asv.max_internal_distance", F.size("targets").cast("long").alias("n_targets"))


@query(_with(_ca, "SELECT asv_id, any_value(c1) AS r1, any_value(c2) AS r2, count(*) AS final_surviving_cell_count FROM fc GROUP BY asv_id"))
def q41_asvs(spark, sf_dir):
    return _final_asvs(spark, sf_dir).select("asv_id", "core_sequence.r1", "core_sequence.r2", "final_surviving_cell_count")


def _final_sequences(spark, sf_dir) -> DataFrame:
    s = Steps(spark, sf_dir)
    phases = sequences.phase_calls(s.ranked_names().where("retained"), surrogate.panel(spark).select("target", "mode"))
    return results.final_sequences(_final(spark, sf_dir), s.ranked_names(), RUN_ID, phases)


@query(_with(_ca + _phase, "SELECT nk.sequence_id AS sequence_cluster_id, nk.target AS parent_target, nk.d1 AS r1, u.n AS final_surviving_cell_count, CASE WHEN pb.b IS NULL THEN 'no_ssr_detected' ELSE 'ssr_detected' END AS call FROM (SELECT sid, count(*) AS n FROM asg JOIN fc USING (cell) WHERE kind = 'sequence_cluster' GROUP BY sid) u JOIN nk ON nk.sequence_id = u.sid LEFT JOIN pb ON pb.key = u.sid"))
def q42_target_sequences(spark, sf_dir):
    return _final_sequences(spark, sf_dir).select("sequence_cluster_id", "parent_target", "core_sequence.r1", "final_surviving_cell_count", F.col("phase_variation.call").alias("call"))


@query(_with(_ca, """SELECT 'raw_unique_barcodes' AS metric, count(*) AS value FROM bc UNION ALL SELECT 'clustered_barcodes', count(DISTINCT cell) FROM cells UNION ALL SELECT 'after_stage1_taxonomy_filter', count(*) FROM s1
 UNION ALL SELECT 'after_minimum_cells_per_taxon', count(*) FROM sz UNION ALL SELECT 'before_asv_filter', count(*) FROM ai UNION ALL SELECT 'after_asv_status_filter', count(*) FROM ok
 UNION ALL SELECT 'asv_taxonomy_conflicts_removed', count(*) FILTER (WHERE conflict) FROM ju UNION ALL SELECT 'before_asv_abundance_filter', count(*) FROM al UNION ALL SELECT 'final_cells', count(*) FROM fc"""))
def q43_barcode_funnel(spark, sf_dir):
    s, one = Steps(spark, sf_dir), F.count(F.lit(1)).alias("value")
    alive, c = F.col("final_filter.stage").isin("final", "asv_abundance"), _candidates(spark, sf_dir)
    conflict = F.col("final_filter.stage") == "asv_taxonomy_conflict"
    rows = [
        ("raw_unique_barcodes", s.packets().select("barcode").distinct().agg(one)), ("clustered_barcodes", s.packets().select("cell").distinct().agg(one)),
        ("after_stage1_taxonomy_filter", s.stage1().agg(one)), ("after_minimum_cells_per_taxon", s.sized().agg(one)), ("before_asv_filter", c.agg(one)),
        ("after_asv_status_filter", c.where(alive | conflict).agg(one)), ("asv_taxonomy_conflicts_removed", c.where(conflict).agg(one)), ("before_asv_abundance_filter", c.where(alive).agg(one)), ("final_cells", _final(spark, sf_dir).agg(one))]
    out = None
    for name, df in rows:
        row = df.select(F.lit(name).alias("metric"), "value")
        out = row if out is None else out.unionByName(row)
    return out


_ts = """SELECT v.target AS target_name, count(b.n) AS original_positive_cells, count(b.n) FILTER (WHERE filtered = 0) AS filtered_out_cells, count(b.n) FILTER (WHERE filtered > 0) AS remaining_positive_cells,
 count(b.n) FILTER (WHERE filtered > 0 AND f.cell IS NULL) AS asv_abundance_excluded_positive_cells, count(b.n) FILTER (WHERE filtered > 0 AND f.cell IS NOT NULL) AS final_positive_cells,
 round(CASE WHEN count(b.n) > 0 THEN count(b.n) FILTER (WHERE filtered > 0 AND f.cell IS NOT NULL) / count(b.n) * 100 ELSE 0 END, 9) AS retention_percent FROM (VALUES ('T1'), ('T2')) v(target) LEFT JOIN bg b USING (target) LEFT JOIN fc f USING (cell) GROUP BY ALL"""


@query(_with(_ca, _ts))
def q44_target_filtering_summary(spark, sf_dir):
    s = Steps(spark, sf_dir)
    out = results.target_summary(cells.background_stats(s.tested(), TARGETS), _final(spark, sf_dir))
    return out.drop("panel_index").withColumn("retention_percent", r9("retention_percent"))


# results with planted faults: by a barcode's first letter and a variant's number
_faults = """SELECT rule, CAST(n AS BIGINT) AS n FROM (
 SELECT 'cell_numbers' AS rule, count(*) AS n FROM fc WHERE cell LIKE 'A%' UNION ALL SELECT 'cell_status', count(*) FROM fc WHERE cell LIKE 'C%' UNION ALL SELECT 'cell_identity', count(*) FROM fc WHERE cell LIKE 'G%'
 UNION ALL SELECT 'target_count', count(*) FROM asg JOIN fc USING (cell) WHERE cell LIKE 'T%' AND kind = 'filtered_out'
 UNION ALL SELECT 'asv_name', count(DISTINCT asv_id) FROM fc WHERE CAST(substr(asv_id, 5) AS INT) % 2 = 0 UNION ALL SELECT 'asv_cells', 2 * count(DISTINCT asv_id) FROM fc WHERE CAST(substr(asv_id, 5) AS INT) % 2 = 0
 UNION ALL SELECT 'excluded_reason', count(*) FROM fc WHERE cell LIKE 'A%' UNION ALL SELECT 'passed_is_final', count(*) FROM fc WHERE cell LIKE 'A%'
 UNION ALL SELECT 'same_record', count(*) FROM fc WHERE cell LIKE 'C%' OR cell LIKE 'T%' AND EXISTS (SELECT 1 FROM asg WHERE asg.cell = fc.cell AND kind = 'filtered_out')
 UNION ALL SELECT 'passed_asv_is_final', count(DISTINCT asv_id) FROM fc WHERE CAST(substr(asv_id, 5) AS INT) % 2 = 0) WHERE n > 0"""


@query(_with(_ca, _faults))
def q45_fk_violations(spark, sf_dir):
    s = Steps(spark, sf_dir)
    letter = F.substring("cell_barcode", 1, 1)
    c, f, a = _candidates(spark, sf_dir), _final(spark, sf_dir), _final_asvs(spark, sf_dir)
    worse = F.transform("targets", lambda t: t.withField("filtered_read_count", F.when(t["assignment_type"] == "filtered_out", F.lit(5)).otherwise(t["filtered_read_count"]).cast("long")))
    asv = F.when(letter == "A", F.col("asv").withField("reads_used", F.lit(-1).cast("long"))).when(letter == "C", F.col("asv").withField("status", F.lit("odd"))).otherwise(F.col("asv"))
    bad = f.withColumn("asv", asv).withColumn("targets", F.when(letter == "T", worse).otherwise(F.col("targets"))).withColumn("run_id", F.when(letter == "G", "other").otherwise(F.col("run_id")))
    no = F.regexp_extract("asv_id", r"(\d+)$", 1).cast("int")
    renamed = a.withColumn("asv_id", F.when(no % 2 == 0, F.concat(F.lit("X"), no.cast("string"))).otherwise(F.col("asv_id")))
    lost = c.withColumn("final_filter", F.when((letter == "A") & F.col("final_filter.passed"), F.col("final_filter").withField("passed", F.lit(False))).otherwise(F.col("final_filter")))
    found = results.violations(RUN_ID, bad, renamed, _final_sequences(spark, sf_dir), TARGETS)
    found = found.unionByName(results.provenance_violations(RUN_ID, lost, results.candidate_asvs(c, s.asvs(), RUN_ID, s.p.variants), bad, renamed, s.p.variants))
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(0 AS BIGINT) AS n")
def q58_sound_results(spark, sf_dir):
    """What the validators find in results as they are: nothing."""
    s = Steps(spark, sf_dir)
    c, f, a = _candidates(spark, sf_dir), _final(spark, sf_dir), _final_asvs(spark, sf_dir)
    found = results.violations(RUN_ID, f, a, _final_sequences(spark, sf_dir), TARGETS)
    found = found.unionByName(results.provenance_violations(RUN_ID, c, results.candidate_asvs(c, s.asvs(), RUN_ID, s.p.variants), f, a, s.p.variants))
    return found.agg(F.count(F.lit(1)).alias("n"))


_value = lambda t: f"coalesce((SELECT any_value(CASE kind WHEN 'sequence_cluster' THEN sid WHEN 'sequence_unresolved' THEN concat(target, '_parent') WHEN 'filtered_out' THEN '0' ELSE CAST(filtered AS VARCHAR) END) FROM asg WHERE asg.cell = fc.cell AND asg.target = '{t}'), '0')"


@query(_with(_ca, f"SELECT cell AS barcode, lineage, asv_id, {_value('T1')} AS t1, {_value('T2')} AS t2 FROM fc"))
def q46_cell_target_matrix(spark, sf_dir):
    return results.cell_target_matrix(_final(spark, sf_dir), TARGETS).select(F.col("Barcode").alias("barcode"), F.col("Predicted taxonomy").alias("lineage"), F.col("Assigned_core_asv").alias("asv_id"), F.col("T1").alias("t1"), F.col("T2").alias("t2"))


@query(_with(_ca, "SELECT lineage, count(*) AS cells FROM fc GROUP BY ALL"))
def q47_taxonomy_summary(spark, sf_dir):
    return results.taxonomy_report(_final(spark, sf_dir)).toDF("lineage", "cells")


@query(_with(_ca, "SELECT 'cells' AS section, 'final_cells' AS metric, count(*) AS value FROM fc UNION ALL SELECT 'asvs', 'final_asv_count', count(DISTINCT asv_id) FROM fc UNION ALL SELECT 'targets', concat(v.target, '.positive_cells'), (SELECT count(*) FROM bg JOIN fc USING (cell) WHERE bg.target = v.target AND filtered > 0) FROM (VALUES ('T1'), ('T2')) v(target)"))
def q48_summary_kv(spark, sf_dir):
    s, f = Steps(spark, sf_dir), _final(spark, sf_dir)
    head = f.agg(F.count(F.lit(1)).alias("final_cells"), F.countDistinct("asv.asv_id").alias("final_asv_count")).unpivot([], ["final_cells", "final_asv_count"], "metric", "value")
    head = head.select(F.when(F.col("metric") == "final_cells", "cells").otherwise("asvs").alias("section"), "metric", "value")
    targets = results.target_summary(cells.background_stats(s.tested(), TARGETS), f)
    return head.unionByName(targets.select(F.lit("targets").alias("section"), F.concat("target_name", F.lit(".positive_cells")).alias("metric"), F.col("final_positive_cells").alias("value")))


@query(_with(_ca, "SELECT asv_id, round(CASE WHEN avg(CASE WHEN p1 THEN 1 ELSE 0 END) < 0.01 THEN 0 ELSE avg(CASE WHEN p1 THEN 1 ELSE 0 END) END, 9) AS t1, round(CASE WHEN avg(CASE WHEN p2 THEN 1 ELSE 0 END) < 0.01 THEN 0 ELSE avg(CASE WHEN p2 THEN 1 ELSE 0 END) END, 9) AS t2 FROM (SELECT asv_id, EXISTS (SELECT 1 FROM bg b WHERE b.cell = fc.cell AND b.target = 'T1' AND filtered > 0) AS p1, EXISTS (SELECT 1 FROM bg b WHERE b.cell = fc.cell AND b.target = 'T2' AND filtered > 0) AS p2 FROM fc) GROUP BY asv_id HAVING count(*) >= 2"))
def q49_asv_target_fraction(spark, sf_dir):
    out = results.asv_target_fractions(_final(spark, sf_dir), _final_asvs(spark, sf_dir), TARGETS, 2, 0.01)
    return out.select("asv_id", r9("T1").alias("t1"), r9("T2").alias("t2"))


@query(_with(_cl, "SELECT size, count(*) AS groups, round(sum(size * count(*)) OVER (ORDER BY size) / sum(size * count(*)) OVER (), 9) AS share FROM (SELECT cell, count(*) AS size FROM pk GROUP BY cell) GROUP BY size"))
def q50_group_size_lorenz(spark, sf_dir):
    sizes = Steps(spark, sf_dir).packets().groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    return cells.lorenz(sizes).withColumn("share", r9("share"))


@query(_with(_bg, "SELECT cell, target, round(n / (n + s16), 9) AS ratio FROM tc"))
def q51_primer_balance(spark, sf_dir):
    s = Steps(spark, sf_dir)
    return cells.ratios(s.alive(), s.counts()).withColumn("ratio", r9("ratio"))


@query(_with(_bg, "SELECT target, CAST(least(floor((n / (n + s16) - 0.1) / 0.9 * 100) + 1, 100) AS BIGINT) AS bin, count(*) AS n FROM tc WHERE n / (n + s16) >= 0.1 GROUP BY ALL"))
def q52_primer_balance_hist(spark, sf_dir):
    s = Steps(spark, sf_dir)
    return cells.ratio_histogram(cells.ratios(s.alive(), s.counts()))


# ---- validation
_bad = """fq AS (SELECT read_index, CASE WHEN read_index % 101 = 7 THEN concat('@X', read_index) ELSE concat('@R', read_index) END AS h1, CASE WHEN read_index % 211 = 5 THEN concat('R', read_index) ELSE concat('@R', read_index, ' x') END AS h2,
  CASE WHEN read_index % 97 = 3 THEN concat('N', substr(fq1, 2)) WHEN read_index % 89 = 2 THEN concat('x', fq1) ELSE fq1 END AS s1, CASE WHEN read_index % 83 = 9 THEN concat('u', fq2) ELSE fq2 END AS s2, CASE WHEN read_index % 79 = 8 THEN '+a' ELSE '+' END AS p1 FROM reads)"""


@query(_with(_reads + ", " + _bad, """SELECT * FROM (SELECT read_index, CASE WHEN split_part(h1, ' ', 1) <> split_part(h2, ' ', 1) THEN 'ids' WHEN h1 NOT LIKE '@%' THEN 'at' WHEN NOT regexp_full_match(s1, '[ATCGN]*') THEN 'forward' WHEN NOT regexp_full_match(s2, '[ATCGN]*') THEN 'reverse' WHEN p1 <> '+' THEN 'plus' END AS rule FROM fq) WHERE rule IS NOT NULL"""))
def q53_fastq_validation(spark, sf_dir):
    from tessera.sources import fastq

    n = F.col("read_index").cast("string")
    own = surrogate.reads(spark, sf_dir).select(
        "read_index", F.when(F.col("read_index") % 101 == 7, F.concat(F.lit("@X"), n)).otherwise(F.concat(F.lit("@R"), n)).alias("r1_header"), F.when(F.col("read_index") % 211 == 5, F.concat(F.lit("R"), n)).otherwise(F.concat(F.lit("@R"), n, F.lit(" x"))).alias("r2_header"),
        F.when(F.col("read_index") % 97 == 3, F.concat(F.lit("N"), F.expr("substr(fq1, 2)"))).when(F.col("read_index") % 89 == 2, F.concat(F.lit("x"), "fq1")).otherwise(F.col("fq1")).alias("r1_seq"),
        F.when(F.col("read_index") % 83 == 9, F.concat(F.lit("u"), "fq2")).otherwise(F.col("fq2")).alias("r2_seq"), F.when(F.col("read_index") % 79 == 8, "+a").otherwise("+").alias("r1_sep"), F.lit("+").alias("r2_sep"))
    return fastq.violations(own)


_oligo = lambda k: f"substr(translate(md5(concat('{k}', CAST(p_partkey AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 20)"
_bad_panel = f"""SELECT CAST(p_partkey - 1 AS INT) AS panel_index, CASE WHEN p_partkey % 97 = 3 THEN 'T1' ELSE concat('T', CAST(p_partkey AS STRING)) END AS target,
 CASE WHEN p_partkey % 89 = 5 THEN 'ACGTACGT' WHEN p_partkey % 83 = 2 THEN concat('N', {_oligo('f')}) ELSE {_oligo('f')} END AS fwd,
 CASE WHEN p_partkey % 89 = 5 THEN 'ACGTACGT' WHEN p_partkey % 73 = 4 THEN concat({_oligo('r')}, 'n') ELSE {_oligo('r')} END AS rev,
 CASE WHEN p_partkey % 79 = 6 THEN 'family' WHEN p_partkey % 2 = 0 THEN 'ssr' ELSE '' END AS mode FROM """


@query("WITH p AS (" + _bad_panel + """part)
SELECT * FROM (SELECT panel_index, CASE WHEN row_number() OVER (PARTITION BY target ORDER BY panel_index) > 1 THEN 'duplicate_name' WHEN row_number() OVER (PARTITION BY fwd, rev ORDER BY panel_index) > 1 THEN 'duplicate_sequences'
 WHEN NOT regexp_full_match(fwd, '[ATCG]*') THEN 'forward_letters' WHEN NOT regexp_full_match(rev, '[ATCG]*') THEN 'reverse_letters' WHEN mode NOT IN ('', 'ssr') THEN 'mode' WHEN panel_index = 0 AND lower(target) <> '16s' THEN 'first_is_16s' END AS rule FROM p) WHERE rule IS NOT NULL""")
def q54_primer_validation(spark, sf_dir):
    from tessera.sources import tables

    return tables.panel_violations(spark.sql(_bad_panel + "{part}", part=spark.read.parquet(f"{sf_dir}/part.parquet")))


# ---- primer toolkit: parts as candidates, their hashed ids as oligos; twenty parts of five genes make a pool
_pool = f"pr AS (SELECT CAST(floor(p_partkey / 20) AS BIGINT) AS pool, p_partkey % 5 AS gene_idx, concat('p', CAST(p_partkey AS STRING)) AS primer_id, {_oligo('f')} AS fwd, {_oligo('r')} AS rev FROM {{part}})"


def _pool_df(spark, sf_dir) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql("WITH " + _pool + " SELECT pool, CAST(gene_idx AS INT) AS gene_idx, CAST(gene_idx AS STRING) AS gene, primer_id, fwd, rev FROM pr", part=part)


_dim = _pool.format(part="part") + """, ol AS (SELECT least(a.primer_id, b.primer_id) AS id_lo, greatest(a.primer_id, b.primer_id) AS id_hi, [a.fwd, a.rev, b.fwd, b.rev] AS o FROM pr a JOIN pr b ON a.pool = b.pool AND a.gene_idx < b.gene_idx),
op AS (SELECT id_lo, id_hi, x, unnest(o) AS y FROM (SELECT id_lo, id_hi, o, unnest(o) AS x FROM ol)),
ds AS (SELECT id_lo, id_hi, min(-CAST(20 - hamming(x, y) AS DOUBLE)) AS delta_g FROM op GROUP BY ALL)"""


@query("WITH " + _dim + " SELECT id_lo, id_hi, delta_g FROM ds")
def q55_dimer_pairs(spark, sf_dir):
    return primers.dimer_scores(_pool_df(spark, sf_dir), primers.equal_places, "pool").drop("pool")


@query("WITH " + _dim + ", ch AS (SELECT min(primer_id) AS primer_id FROM pr GROUP BY pool, gene_idx) SELECT round(avg(delta_g), 9) AS avg_score, min(delta_g) AS min_score, round(avg(delta_g) + min(delta_g), 9) AS rank_score FROM ds WHERE id_lo IN (SELECT primer_id FROM ch) AND id_hi IN (SELECT primer_id FROM ch)")
def q56_pool_score(spark, sf_dir):
    pool = _pool_df(spark, sf_dir)
    chosen = pool.groupBy("pool", "gene_idx").agg(F.min("primer_id").alias("primer_id"))
    out = primers.pool_score(chosen, primers.dimer_scores(pool, primers.equal_places, "pool"))
    return out.select(r9("avg_score").alias("avg_score"), "min_score", r9("rank_score").alias("rank_score"))


@query()
def q57_annealing(spark, sf_dir):
    """Chains over every pool of a hundred parts, by the energies of duplexes."""
    pools = _pool_df(spark, sf_dir).withColumn("pool", F.expr("CAST(substr(primer_id, 2) AS BIGINT) div 100"))
    out = primers.anneal_chains(pools, fixed=1, pool="pool")
    return out.select("pool", "chain", "rank_score", "avg_score", "min_score", F.concat_ws(",", "primers").alias("primers"))


# ---- from files: scan, pair, quality, primers, classifier, cells
_scan = _reads.replace("reads AS", "raw AS", 1)
_gene1 = "coalesce(" + ", ".join([f"CASE WHEN substr(fq2, 43, {len(r)}) = '{r}' AND substr(fq1, 1, {len(f)}) = '{f}' THEN {k} END" for k, _, f, r, _ in PANEL[1:]] + [f"CASE WHEN {_match_sql('fq2', r, 42)} AND {_match_sql('fq1', f, 0)} THEN {k} END" for k, _, f, r, _ in PANEL[1:]]) + ")"
_found = _scan + _qc[len(_reads):].replace("FROM reads", "FROM raw") + _expand(f""", kept AS (SELECT raw.* FROM raw JOIN qc USING (read_index) WHERE qc_reason IS NULL),
placed AS (SELECT *, CASE WHEN coalesce({_match_sql('fq2', REV, 42)}, false) THEN {_start_sql('fq1', FWD)} END AS start FROM kept),
pq AS (SELECT *, CASE WHEN start IS NOT NULL THEN 0 ELSE {_gene1} END AS pix, substr(fq2, 1, 20) AS code FROM placed)""")


@query(_with(_scan, "SELECT row_number() OVER (ORDER BY read_index) - 1 AS place, read_id, fq1 AS r1, q1 AS r1_qual, fq2 AS r2, q2 AS r2_qual FROM raw"))
def q59_fastq_scan(spark, sf_dir):
    pairs = _scanned(spark, sf_dir)
    return pairs.select(F.col("read_index").alias("place"), "read_id", F.col("r1_seq").alias("r1"), "r1_qual", F.col("r2_seq").alias("r2"), "r2_qual")


def _scanned(spark, sf_dir) -> DataFrame:
    from tessera.sources import fastq

    at = surrogate.files(spark, sf_dir)
    return fastq.read_pairs(spark, at["r1"], at["r2"])


def _found_packets(spark, sf_dir) -> DataFrame:
    def make() -> DataFrame:
        passed = demux.with_qc(_scanned(spark, sf_dir)).where("qc_reason is null").drop("qc_reason")
        return demux.packets(demux.place_16s(passed, FWD, REV), PANEL)

    return surrogate.kept(spark, sf_dir, "found", make)


@query(_with(_found, "SELECT read_id, CAST(start AS INT) AS primer_start, CAST(pix AS INT) AS panel_index, CASE WHEN pix = 0 THEN '16s' WHEN pix > 0 THEN 'target' ELSE 'unclassified' END AS gene_class, code AS barcode FROM pq"))
def q60_fastq_packets(spark, sf_dir):
    return _found_packets(spark, sf_dir).select("read_id", F.col("r1_primer_start").alias("primer_start"), "panel_index", "gene_class", "barcode")


_labelled = _found + f""", lb AS (SELECT *, {surrogate.LABEL} AS l FROM pq),
reads AS (SELECT read_index, read_id, code AS barcode, CASE WHEN pix = 0 THEN '16s' WHEN pix > 0 THEN 'target' ELSE 'unclassified' END AS gene_class, CASE WHEN pix > 0 THEN concat('T', pix) END AS target, fq1 AS r1, fq2 AS r2,
  CASE WHEN known THEN 'Bacteria' END AS R1k, CASE WHEN known THEN concat('P', strain % 3) END AS P, CASE WHEN known THEN concat('C', strain % 3) END AS C, CASE WHEN known THEN concat('O', strain % 6) END AS O,
  CASE WHEN known THEN concat('F', strain % 6) END AS F, CASE WHEN known THEN concat('G', strain) END AS G, CAST(NULL AS VARCHAR) AS S FROM (SELECT *, l NOT IN ('0', '1', 'g__missing') AS known FROM lb))"""


@query(_with(_labelled + _su[len(_reads):], f"SELECT s.cell, {_lineage_sql()} AS lineage, s.total AS total_16s, s.noise, round(s.conf, 9) AS confidence, round(s.contamination, 9) AS contamination, c.reads FROM su s JOIN (SELECT cell, count(*) AS reads FROM pk GROUP BY cell) c USING (cell)"))
def q61_fastq_cells(spark, sf_dir):
    from tessera.sources import tables

    at = surrogate.files(spark, sf_dir)
    packets = demux.classify(_found_packets(spark, sf_dir), tables.read_classified(spark, at["labels"]), tables.read_taxa(spark, at["report"]))
    clustered = surrogate.kept(spark, sf_dir, "found-cells", lambda: barcodes.with_cells(packets.select("read_index", "read_id", "barcode", "gene_class", "path")))
    summary = cells.consensus(cells.path_counts(clustered))
    reads = clustered.groupBy("cell").agg(F.count(F.lit(1)).alias("reads"))
    return summary.join(reads, "cell").select("cell", S.lineage(F.col("path")).alias("lineage"), "total_16s", "noise", r9("confidence").alias("confidence"), r9("contamination").alias("contamination"), "reads")


@query(_with(_cl, """, sz0 AS (SELECT cell, count(*) FILTER (WHERE gene_class = '16s') AS a, count(*) FILTER (WHERE gene_class = 'target') AS t, count(*) AS n FROM pk GROUP BY cell),
sz AS (SELECT '16s' AS series, a AS size FROM sz0 WHERE a > 0 UNION ALL SELECT 'classified', a + t FROM sz0 WHERE a > 0 UNION ALL SELECT 'all', n FROM sz0)
SELECT series, size, count(*) AS groups, round(sum(size * count(*)) OVER (PARTITION BY series ORDER BY size) / sum(size * count(*)) OVER (PARTITION BY series), 9) AS share FROM sz GROUP BY series, size"""))
def q62_group_curves(spark, sf_dir):
    return cells.group_curves(cells.group_sizes(Steps(spark, sf_dir).packets())).withColumn("share", r9("share"))


@query()
def q63_dimer_energies(spark, sf_dir):
    return primers.dimer_scores(_pool_df(spark, sf_dir), pool="pool").drop("pool").withColumn("delta_g", r9("delta_g"))


#: The last bases of an oligo, which begin its extension; a duplex of so few is a walk over few pairs of bases, which SQL can go.
TAIL = 6
_model = duplex.Model()


def _gap_sql() -> str:
    """What lies between two pairs of a duplex, by the unpaired bases of either side (l, r): a constant, and whether the stack, or both ends, count as well."""
    cost = lambda a, b: _model.bulge[a + b] if not a * b else _model.internal[a + b] + _model.uneven * abs(a - b)
    rows = [f"({a}, {b}, {cost(a, b)}, {int(a + b < 2)}, {int(a + b > 1 and not a * b)})" for a in range(TAIL) for b in range(TAIL) if a + b <= duplex.LOOP]
    return "gap(l, r, cost, stacked, ends) AS (VALUES " + ", ".join(rows) + ")"


_stack_sql = "st(two, e) AS (VALUES " + ", ".join(f"('{a}{b}', {_model.stack[i, j]})" for i, a in enumerate("ACGT") for j, b in enumerate("ACGT")) + ")"
_tails = "RECURSIVE " + _pool.format(part="part") + f""", ol AS (SELECT least(a.primer_id, b.primer_id) AS id_lo, greatest(a.primer_id, b.primer_id) AS id_hi, list_transform([a.fwd, a.rev, b.fwd, b.rev], lambda s: right(s, {TAIL})) AS o FROM pr a JOIN pr b ON a.pool = b.pool AND a.gene_idx < b.gene_idx),
op AS (SELECT id_lo, id_hi, x, unnest(o) AS y FROM (SELECT id_lo, id_hi, o, unnest(o) AS x FROM ol)),
xy AS (SELECT DISTINCT x, y FROM op), {_gap_sql()}, {_stack_sql},
-- pairs of bases: x's i-th with y's j-th from its end; weak ones cost at an end
bp AS (SELECT x, y, i, j, substr(x, CAST(i AS INT), 1) AS c, CASE WHEN substr(x, CAST(i AS INT), 1) IN ('A', 'T') THEN {_model.weak} ELSE 0 END AS w
 FROM xy, range(1, {TAIL + 1}) a(i), range(1, {TAIL + 1}) b(j) WHERE substr(x, CAST(i AS INT), 1) = translate(substr(y, CAST({TAIL + 1} - j AS INT), 1), 'ACGT', 'TGCA')),
du AS (SELECT x, y, i, j, c, w, {_model.begin} + w AS e FROM bp
 UNION ALL
 SELECT n.x, n.y, n.i, n.j, n.c, n.w, min(d.e + g.cost + g.stacked * st.e + g.ends * (d.w + n.w))
 FROM du d JOIN bp n ON d.x = n.x AND d.y = n.y AND n.i > d.i AND n.j > d.j JOIN gap g ON g.l = n.i - d.i - 1 AND g.r = n.j - d.j - 1 JOIN st ON st.two = concat(d.c, n.c) GROUP BY ALL),
en AS (SELECT x, y, least(0, min(e + w)) AS e FROM du WHERE i = {TAIL} GROUP BY x, y),
ds AS (SELECT id_lo, id_hi, min(coalesce(e, 0)) / 1000 AS delta_g FROM op LEFT JOIN en USING (x, y) GROUP BY ALL)"""


@query("WITH " + _tails + " SELECT id_lo, id_hi, round(delta_g, 9) AS delta_g FROM ds")
def q64_tail_energies(spark, sf_dir):
    return primers.dimer_scores(_pool_df(spark, sf_dir), pool="pool", tail=TAIL).drop("pool").withColumn("delta_g", r9("delta_g"))


@query("WITH " + _tails + ", ch AS (SELECT min(primer_id) AS primer_id FROM pr GROUP BY pool, gene_idx) SELECT round(avg(delta_g), 9) AS avg_score, round(min(delta_g), 9) AS min_score, round(avg(delta_g) + min(delta_g), 9) AS rank_score FROM ds WHERE id_lo IN (SELECT primer_id FROM ch) AND id_hi IN (SELECT primer_id FROM ch)")
def q65_tail_score(spark, sf_dir):
    pool = _pool_df(spark, sf_dir)
    chosen = pool.groupBy("pool", "gene_idx").agg(F.min("primer_id").alias("primer_id"))
    out = primers.pool_score(chosen, primers.dimer_scores(pool, pool="pool", tail=TAIL))
    return out.select(*[r9(c).alias(c) for c in ("avg_score", "min_score", "rank_score")])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells by lineage: reads to barcodes to consensus to the stage-1 filter."""
    own = cells.taxon_size(Steps(spark, sf_dir).stage1(), 1)
    return own.groupBy(S.lineage(F.col("path")).alias("lineage")).agg(F.count(F.lit(1)).alias("cells"), F.sum("total_16s").alias("reads"))


# those from files register here as well
from tessera.plans import file_queries  # noqa: E402, F401
