"""Named queries from written files to results, over published results and their reports, and over input files with planted faults.

The module registers them beside those of ``queries``, whose SQL parts theirs build on.
"""

from __future__ import annotations

from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import seq as S
from tessera.operators import cells, demux, order, primers, sequences
from tessera.params import Params, Targets
from tessera.plans import queries as Q
from tessera.plans import reports, results, run, surrogate
from tessera.plans.queries import RUN_ID, query, r9
from tessera.plans.surrogate import PANEL, PARAMS, TARGETS, Steps
from tessera.sources import fastq, tables, validate
from tessera.storage import fresh_path, release, write_text

#: What the SQL parts of queries state, as parameters of a run.
RUN_PARAMS = replace(PARAMS, targets=replace(PARAMS.targets, background_alpha=0.5))


def _once(spark: SparkSession, sf_dir: str, what: str, make):
    """What several queries use, made once a session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in surrogate._kept:
        surrogate._kept[key] = make()
    return surrogate._kept[key]


def _panel_text() -> str:
    return "Primer,F,R,Mode\n" + "".join(f"{t},{f},{r},{m}\n" for _, t, f, r, m in PANEL)


# ---- a whole run, from read files, a panel, a classifier's labels and its report
#: Reads as the files hold them; R1 from its primer on, so that cores are where they are in made packets.
_filed = Q._labelled.replace("END AS target, fq1 AS r1,", "END AS target, substr(fq1, CAST(coalesce(start, 0) + 1 AS INT)) AS r1,", 1)
_run = _filed + Q._ca[len(Q._reads):]


def _file_run(spark: SparkSession, sf_dir: str) -> run.Results:
    def make() -> run.Results:
        at = surrogate.files(spark, sf_dir)
        panel = fresh_path(spark, "panel") + ".csv"
        write_text(spark, panel, _panel_text())
        pairs = fastq.read_pairs(spark, at["r1"], at["r2"])
        done = run.run(pairs, tables.read_panel(spark, panel), tables.read_classified(spark, at["labels"]), tables.read_taxa(spark, at["report"]), RUN_PARAMS)
        release(pairs)
        return done

    return _once(spark, sf_dir, "file-run", make)


@query(Q._with(_run, "SELECT cd.cell AS cell_barcode, cd.stage, cd.reason, ai.asv_id, ai.lineage, ai.total_16s AS total_16s_reads, ai.reads_used, ai.max_distance AS max_internal_distance FROM cd JOIN ai USING (cell)"))
def q66_run_cells(spark, sf_dir):
    """All candidate cells of a run from files, and what became of them."""
    ranks = F.col("taxonomy.ranks")
    path = F.struct(*[ranks[n].alias(c) for c, n in S.RANKS.items()])
    return _file_run(spark, sf_dir).candidates.select("cell_barcode", "final_filter.stage", "final_filter.reason", "asv.asv_id", S.lineage(path).alias("lineage"), "taxonomy_evidence.total_16s_reads", "asv.reads_used", "asv.max_internal_distance")


@query(Q._with(_run, "SELECT asv_id, any_value(c1) AS r1, any_value(c2) AS r2, count(*) AS final_surviving_cell_count FROM fc GROUP BY asv_id"))
def q67_run_asvs(spark, sf_dir):
    return _file_run(spark, sf_dir).asvs.select("asv_id", "core_sequence.r1", "core_sequence.r2", "final_surviving_cell_count")


_reads_part = """SELECT 'reads' AS section, 'raw_read_pairs' AS metric, count(*) AS value FROM qc UNION ALL SELECT 'reads', 'passed_read_pairs', count(*) FROM qc WHERE qc_reason IS NULL UNION ALL SELECT 'reads', 'filtered_read_pairs', count(*) FROM qc WHERE qc_reason IS NOT NULL
 UNION ALL SELECT 'reads', 'accepted_16s_reads', count(*) FROM pq WHERE pix = 0 UNION ALL SELECT 'reads', 'target_reads', count(*) FROM pq WHERE pix > 0 UNION ALL SELECT 'reads', 'unclassified_reads', count(*) FROM pq WHERE pix IS NULL"""
_cells_part = """SELECT 'cells', 'raw_unique_barcodes', count(*) FROM bc UNION ALL SELECT 'cells', 'clustered_barcodes', count(DISTINCT cell) FROM cells UNION ALL SELECT 'cells', 'after_stage1_taxonomy_filter', count(*) FROM s1
 UNION ALL SELECT 'cells', 'after_minimum_cells_per_taxon', count(*) FROM sz UNION ALL SELECT 'cells', 'before_asv_filter', count(*) FROM ai UNION ALL SELECT 'cells', 'after_asv_status_filter', count(*) FROM ok
 UNION ALL SELECT 'cells', 'asv_taxonomy_conflicts_removed', count(*) FILTER (WHERE conflict) FROM ju UNION ALL SELECT 'cells', 'before_asv_abundance_filter', count(*) FROM al
 UNION ALL SELECT 'cells', 'asv_abundance_filtered_cells', (SELECT count(*) FROM al) - (SELECT count(*) FROM fc) UNION ALL SELECT 'cells', 'final_cells', count(*) FROM fc UNION ALL SELECT 'asvs', 'final_asv_count', count(DISTINCT asv_id) FROM fc
 UNION ALL SELECT 'targets', concat(v.target, '.positive_cells'), (SELECT count(*) FROM bg JOIN fc USING (cell) WHERE bg.target = v.target AND filtered > 0) FROM (VALUES ('T1'), ('T2')) v(target)"""


@query(Q._with(_run, f"{_reads_part} UNION ALL {_cells_part}"))
def q68_run_record(spark, sf_dir):
    """The record of a run from files: reads, the funnel of barcodes, variants and targets."""
    return results.overview(spark, _file_run(spark, sf_dir).summary).where("section <> 'phase_variation'")


@query(Q._with(_run, Q._ts))
def q69_run_targets(spark, sf_dir):
    return _file_run(spark, sf_dir).target_summary.drop("panel_index").withColumn("retention_percent", r9("retention_percent"))


# ---- published results and their reports, read back from their files
def _published(spark: SparkSession, sf_dir: str) -> str:
    """The surrogate's results as a published folder with its reports; sequences are kept by their rank."""

    def make() -> str:
        s, folder = Steps(spark, sf_dir), fresh_path(spark, "published")
        c, f, a = Q._candidates(spark, sf_dir), Q._final(spark, sf_dir), Q._final_asvs(spark, sf_dir)
        names = s.ranked_names().where("retained")
        phases = sequences.phase_calls(names, surrogate.panel(spark).select("target", "mode"))
        kept = results.final_sequences(f, names, RUN_ID, phases, sequences.reference_matches(names, Q._reference(spark, sf_dir)))
        own = s.packets()
        qc = demux.qc_counts(own.withColumn("qc_reason", F.lit(None).cast("string")))
        count = lambda df: df.count()
        funnel = {"raw_unique_barcodes": count(own.select("barcode").distinct()), "clustered_barcodes": count(own.select("cell").distinct()), "after_stage1_taxonomy_filter": count(s.stage1()), "after_minimum_cells_per_taxon": count(s.sized())}
        all_asvs = results.candidate_asvs(c, s.asvs(), RUN_ID, s.p.variants)
        record = results.run_summary(
            RUN_ID, {"name": "tessera"}, {"reference_fasta": "made"}, PANEL, asdict(s.p), qc, own, demux.stagger_counts(own.where("gene_class = '16s'")), funnel, c, all_asvs, f, a,
            results.target_summary(cells.background_stats(s.tested(), TARGETS), f), results.cell_phases(f, kept))
        results.write_results(folder, record, c, all_asvs, f, a, kept)
        reports.write_reports(spark, folder, f"{folder}/reports")
        return folder

    return _once(spark, sf_dir, "published", make)


def _report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).csv(f"{_published(spark, sf_dir)}/reports/{name}.tsv")


def _report_lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """(place, c): a report's rows in their order, as lists of columns; each of its files has the header."""
    lines = fastq.numbered_lines(spark, f"{_published(spark, sf_dir)}/reports/{name}.tsv").withColumn("c", F.split("line", "\t"))
    head = lines.orderBy("line_no").first()["line"]
    return order.numbered(lines.where(F.col("line") != head), ["line_no"], "place").select("place", "c")


@query(Q._with(Q._ca, "SELECT cell AS cell_barcode, asv_id, lineage, total_16s AS total_16s_reads, noise AS technical_noise_reads, reads_used, max_distance AS max_internal_distance, (SELECT count(*) FROM bg b WHERE b.cell = fc.cell) AS n_targets FROM fc"))
def q70_stored_cells(spark, sf_dir):
    """cells.jsonl of the published folder."""
    c = tables.read_jsonl(spark, f"{_published(spark, sf_dir)}/cells.jsonl", results.CELL)
    ranks = F.col("taxonomy.ranks")
    path = F.struct(*[ranks[n].alias(k) for k, n in S.RANKS.items()])
    return c.select("cell_barcode", "asv.asv_id", S.lineage(path).alias("lineage"), "taxonomy_evidence.total_16s_reads", "taxonomy_evidence.technical_noise_reads", "asv.reads_used", "asv.max_internal_distance", F.size("targets").cast("long").alias("n_targets"))


@query(Q._with(Q._ca, f"SELECT row_number() OVER (ORDER BY lineage, cell) AS place, cell AS barcode, lineage, {Q._value('T1')} AS t1, {Q._value('T2')} AS t2 FROM fc"))
def q71_matrix_report(spark, sf_dir):
    """The wide report as it is written: by lineage and barcode."""
    c = F.col("c")
    return _report_lines(spark, sf_dir, "cell_target_matrix").select("place", c[0].alias("barcode"), c[1].alias("lineage"), c[15].alias("t1"), c[16].alias("t2"))


_calls = "SELECT f.cell, nk.target, nk.sequence_id, CASE WHEN pb.b IS NULL THEN 'no_ssr_detected' ELSE 'ssr_detected' END AS call, pb.b FROM fc f JOIN asg USING (cell) JOIN nk ON nk.sequence_id = asg.sid LEFT JOIN pb ON pb.key = asg.sid WHERE kind = 'sequence_cluster'"


@query(Q._with(Q._ca + Q._phase, f"""SELECT row_number() OVER (ORDER BY cell, target) AS place, cell AS barcode, target, sequence_id AS assignment, call, b.motif AS motif, CAST(b.times AS INT) AS repeat_count, CAST(b.start AS INT) AS first, CAST(b.stop AS INT) AS last FROM ({_calls})"""))
def q72_phase_report(spark, sf_dir):
    c = F.col("c")
    number = lambda k: F.nullif(c[k], F.lit("")).cast("int")
    text = lambda k: F.nullif(F.regexp_replace(c[k], '^""$', ""), F.lit(""))
    return _report_lines(spark, sf_dir, "cell_phase_variation").select("place", c[0].alias("barcode"), c[1].alias("target"), c[3].alias("assignment"), c[4].alias("call"), text(5).alias("motif"), number(6).alias("repeat_count"), number(7).alias("first"), number(8).alias("last"))


_instr = lambda d: f"CASE WHEN instr(seq, {d}) > 0 THEN instr(seq, {d}) WHEN instr(seq, reverse(translate({d}, 'ACGT', 'TGCA'))) > 0 THEN instr(seq, reverse(translate({d}, 'ACGT', 'TGCA'))) END"


@query(Q._with(Q._ca + ", " + Q._ref, f"""SELECT sequence_id AS "sub-ARG_name", title AS subject, CAST(s1 AS INT) AS read1_start, CAST(s1 + length(d1) - 1 AS INT) AS read1_end, '100%' AS read1_percent_identity, CAST(s2 AS INT) AS read2_start, CAST(s2 + length(d2) - 1 AS INT) AS read2_end, '100%' AS read2_percent_identity, d1 AS read1_seq, d2 AS read2_seq
 FROM (SELECT *, {_instr('d1')} AS s1, {_instr('d2')} AS s2 FROM nk CROSS JOIN rf WHERE retained AND sequence_id IN (SELECT sid FROM asg JOIN fc USING (cell) WHERE kind = 'sequence_cluster')) WHERE s1 IS NOT NULL AND s2 IS NOT NULL"""))
def q73_reference_report(spark, sf_dir):
    out = _report(spark, sf_dir, "reference_matches")
    return out.select(*[F.col(f"`{c}`").cast("int").alias(c) if c.endswith(("_start", "_end")) else F.col(f"`{c}`") for c in out.columns])


@query(Q._with(Q._ca + Q._phase, f"""SELECT 'reads' AS section, m AS metric, v AS value FROM (SELECT unnest(['raw_read_pairs', 'passed_read_pairs', 'filtered_read_pairs', 'accepted_16s_reads', 'target_reads', 'unclassified_reads']) AS m,
  unnest([count(*), count(*), 0, count(*) FILTER (WHERE gene_class = '16s'), count(*) FILTER (WHERE gene_class = 'target'), count(*) FILTER (WHERE gene_class = 'unclassified')]) AS v FROM reads)
 UNION ALL {_cells_part} UNION ALL SELECT 'phase_variation', 'cell_calls', count(*) FROM ({_calls}) UNION ALL SELECT 'phase_variation', concat('calls.', call), count(*) FROM ({_calls}) GROUP BY call"""))
def q74_overview_report(spark, sf_dir):
    return _report(spark, sf_dir, "summary").withColumn("value", F.col("value").cast("long"))


@query(Q._with(Q._ca, "SELECT row_number() OVER (ORDER BY CAST(substr(asv_id, 5) AS INT)) AS place, asv_id, count(*) AS cells, concat(any_value(c1), '|', any_value(c2)) AS core FROM fc GROUP BY asv_id"))
def q75_asv_report(spark, sf_dir):
    """Variants as they are listed: by number."""
    c = F.col("c")
    return _report_lines(spark, sf_dir, "asv_summary").select("place", c[0].alias("asv_id"), c[1].cast("long").alias("cells"), c[2].alias("core"))


@query(Q._with(Q._ca, f"SELECT target_name AS target, original_positive_cells AS original, original_positive_cells - final_positive_cells AS filtered_out, final_positive_cells AS remaining, retention_percent AS retention FROM ({Q._ts})"))
def q76_target_report(spark, sf_dir):
    out = _report(spark, sf_dir, "target_summary").toDF("target", "original", "filtered_out", "remaining", "retention")
    return out.select("target", *[F.col(c).cast("long").alias(c) for c in ("original", "filtered_out", "remaining")], r9(F.col("retention").cast("double")).alias("retention"))


@query(Q._with(Q._ca, "SELECT row_number() OVER (ORDER BY count(*) DESC, min(cell)) AS place, lineage, count(*) AS cells FROM fc GROUP BY lineage"))
def q77_taxonomy_report(spark, sf_dir):
    """Lineages as they are listed: by cells, then by the first cell."""
    c = F.col("c")
    return _report_lines(spark, sf_dir, "taxonomy_summary").select("place", c[0].alias("lineage"), c[1].cast("long").alias("cells"))


@query(Q._with(Q._ca + Q._phase, """SELECT al.cell AS cell_barcode, al.lineage, ai.asv_id AS assignment, al.status, al.total_16s AS total_16s_reads, al.reads_used AS reads_used_for_asv,
 coalesce((SELECT string_agg(concat(target, '=', CASE kind WHEN 'sequence_cluster' THEN sid WHEN 'sequence_unresolved' THEN concat(target, '_parent') ELSE target END), ',' ORDER BY target) FROM asg WHERE asg.cell = al.cell AND filtered > 0), '') AS targets,
 coalesce((SELECT string_agg(concat(nk.sequence_id, '=', CASE WHEN pb.b IS NULL THEN 'no_ssr_detected' ELSE 'ssr_detected' END), ',') FROM asg JOIN nk ON nk.sequence_id = asg.sid LEFT JOIN pb ON pb.key = asg.sid WHERE asg.cell = al.cell AND kind = 'sequence_cluster'), '') AS phases
 FROM al JOIN ai USING (cell)"""))
def q78_legacy_export(spark, sf_dir):
    """The flat record of cells before the abundance filter, as it is written and read again."""

    def make() -> str:
        s, path = Steps(spark, sf_dir), fresh_path(spark, "legacy")
        before = Q._candidates(spark, sf_dir).where("final_filter.stage in ('final', 'asv_abundance')")
        names = s.ranked_names().where("retained")
        phases = sequences.phase_calls(names, surrogate.panel(spark).select("target", "mode"))
        tables.write_jsonl(results.legacy_export(before, results.cell_phases(before, results.final_sequences(before, names, RUN_ID, phases))), path)
        return path

    # with its schema: an export without cells, or without calls, has no fields to infer
    own = tables.read_jsonl(spark, _once(spark, sf_dir, "legacy", make), results.LEGACY)
    said = lambda items, a, b: F.array_join(F.transform(items, lambda t: F.concat(t[a], F.lit("="), t[b])), ",")
    return own.select(
        "cell_barcode", "taxonomy.lineage", "asv.assignment", "asv.status", "read_qc.total_16s_reads", "read_qc.reads_used_for_asv", said("targets", "target", "assignment").alias("targets"),
        F.coalesce(said("phase_variation", "sequence_assignment", "call"), F.lit("")).alias("phases"))


# ---- input files, some with planted faults
def _fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A FASTA record for each part: its name, a title, its bases with a gap and in small letters, in two lines."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(f"SELECT p_partkey, concat('>p', CAST(p_partkey AS STRING), ' ', p_brand, '\n', {Q._oligo('f')}, '-\n', lower({Q._oligo('r')})) AS value FROM {{part}}", part=part).orderBy("p_partkey").select("value")


@query(f"SELECT concat('p', p_partkey) AS name, concat('p', p_partkey, ' ', p_brand) AS title, concat({Q._oligo('f')}, {Q._oligo('r')}) AS seq FROM part WHERE NOT contains(concat('p', p_partkey), '7')")
def q79_fasta_scan(spark, sf_dir):
    """A FASTA file of a record a part; records with an excluded term in their name go."""

    def make() -> str:
        path = fresh_path(spark, "fasta")
        _fasta(spark, sf_dir).write.text(path)
        return path

    return tables.read_fasta(spark, _once(spark, sf_dir, "fasta", make), exclude=("P7", "7")).select("name", "title", "seq")


_m = "(SELECT count(*) FROM reads)"


@query(Q._with(Q._reads, f"""SELECT 'sound' AS name, 'Valid' AS verdict
 UNION ALL SELECT 'short', concat('reads, R1 and R2 end at different records, the shorter one before line ', 4 * ({_m} - {_m} // 3) + 1)
 UNION ALL SELECT 'ids', concat('reads, the record at line ', 4 * ({_m} // 2) + 1, ' has another id in R1 than in R2')
 UNION ALL SELECT 'letters', concat('reads, the R2 record at line ', 4 * ({_m} // 5) + 1, ' has other letters than A, C, G, T and N')
 UNION ALL SELECT 'plus', concat('reads, the record at line ', 4 * ({_m} // 7) + 1, ' has no + between bases and qualities')
 UNION ALL SELECT 'panel', concat('primer file, line ', {len(PANEL) + 2}, ': T1 is listed twice')
 UNION ALL SELECT 'panel_columns', 'primer file, line 1: four columns are needed, there are 3'
 UNION ALL SELECT 'legacy_panel', 'Valid'
 UNION ALL SELECT 'fasta', concat('reference, line ', 3 * ((SELECT count(*) FROM part) // 2) + 2, ': a record begins, but the one before it has no sequence')
 UNION ALL SELECT 'fasta_end', 'reference, the last record has no sequence'"""))
def q80_input_checks(spark, sf_dir):
    """What the check of all inputs says of sound files, and of files with one planted fault each."""

    def make() -> list[tuple[str, str]]:
        folder = fresh_path(spark, "inputs")
        own = order.numbered(surrogate.reads(spark, sf_dir).select("read_index", "read_id", "fq1", "q1", "fq2", "q2"), ["read_index"], "place").withColumn("place", F.col("place") - 1)
        n, parts = own.count(), spark.read.parquet(f"{sf_dir}/part.parquet").count()
        own = own.orderBy("place")
        head = lambda mate: F.concat(F.lit("@"), "read_id", F.lit(f" {mate}"))

        def reads(name: str, mate: int, rows: DataFrame, header=None, seq=None, sep=None) -> str:
            path = f"{folder}/{name}"
            fastq.write_fastq(rows, path, head(mate) if header is None else header, F.col(f"fq{mate}") if seq is None else seq, F.col(f"q{mate}"), sep, "gzip" if mate == 2 else "none")
            return path

        at = lambda k, bad, good: F.when(F.col("place") == k, bad).otherwise(good)
        r1, r2 = reads("r1", 1, own), reads("r2", 2, own)
        mates = {
            "short": reads("short", 2, own.where(F.col("place") < n - n // 3)), "ids": reads("ids", 2, own, header=at(n // 2, F.lit("@other"), head(2))),
            "letters": reads("letters", 2, own, seq=at(n // 5, F.concat(F.lit("u"), "fq2"), F.col("fq2"))), "plus": reads("plus", 2, own, sep=at(n // 7, F.lit("-"), F.lit("+")))}
        sound = _panel_text()
        panels = {"panel": sound + f"T1,{PANEL[1][2]}A,{PANEL[1][3]}A,\n", "panel_columns": "Primer,F,R\n", "legacy_panel": "Primer,F,R,Sub-ARG\n" + "".join(f"{t},{f},{r},{'family' if m else 'single'}\n" for _, t, f, r, m in PANEL), "sound": sound}
        for name, text in panels.items():
            write_text(spark, f"{folder}/{name}.csv", text)
        record = order.numbered(_fasta(spark, sf_dir).withColumn("key", F.regexp_extract("value", "^>p([0-9]+)", 1).cast("long")), ["key"], "place").withColumn("place", F.col("place") - 1).orderBy("place")
        cut = lambda k: F.when(F.col("place") == k, F.substring_index("value", "\n", 1)).otherwise(F.col("value")).alias("value")
        for name, k in (("sound", -1), ("fasta", parts // 2), ("fasta_end", parts - 1)):
            record.select(cut(k)).write.text(f"{folder}/{name}.fa")
        out = []
        for name in ("sound", *mates, "panel", "panel_columns", "legacy_panel", "fasta", "fasta_end"):
            out.append((name, validate.check_inputs(spark, r1, mates.get(name, r2), f"{folder}/{name if name in panels else 'sound'}.csv", f"{folder}/{name if name.startswith('fasta') else 'sound'}.fa")))
        return out

    return spark.createDataFrame(_once(spark, sf_dir, "inputs", make), "name string, verdict string")


# ---- small columns over parts: texts of tools, words, species that can't be told apart
_words = "['true', ' Yes', 'Y ', '1', 'false', 'NO', 'n', ' 0 ']"
_said = "CASE WHEN p_partkey % 3 = 0 THEN concat('Calculated thermodynamical parameters for dimer:\\tdS = -12.5\\tdH = -3400\\tdG = ', CAST(p_size AS STRING), '.25\\tt = 3.5') WHEN p_partkey % 3 = 1 THEN concat('dG = -', CAST(p_size AS STRING), '.5 t') ELSE 'none' END"
_texts = f"""tx AS (SELECT p_partkey, p_size, {_said} AS said, concat(CAST(p_size AS STRING), '.5%') AS share,
 CASE WHEN p_partkey % 4 = 0 THEN 'Klebsiella' WHEN p_partkey % 4 = 1 THEN 'Klebsiella oxytoca group' WHEN p_partkey % 4 = 2 THEN 'Genus' END AS genus, concat('S', CAST(p_size AS STRING)) AS species,
 repeat(p_type, 3) AS long FROM {{part}})"""


@query("WITH " + _texts.format(part="part").replace("STRING", "VARCHAR").replace("\\t", "\t") + f""" SELECT p_partkey,
 CAST(CASE WHEN p_partkey % 3 = 0 THEN p_size + 0.25 WHEN p_partkey % 3 = 1 THEN -(p_size + 0.5) END AS DOUBLE) AS number, CAST(p_size + 0.5 AS DOUBLE) AS percent, CASE WHEN length(long) > 60 THEN right(long, 60) ELSE long END AS last,
 (p_partkey % 8) < 4 AS flag, CASE WHEN starts_with(genus, 'Klebsiella') THEN 'Klebsiella pneumoniae complex' ELSE genus END AS genus, CASE WHEN starts_with(genus, 'Klebsiella') THEN NULL ELSE species END AS species FROM tx""")
def q81_tool_texts(spark, sf_dir):
    """Numbers of tool output, percentages, ends of long oligos, words for true and false, and species that become one complex."""
    rows = spark.sql("WITH " + _texts + " SELECT * FROM tx", part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    none = F.lit(None).cast("string")
    path = F.struct(*[{"G": F.col("genus"), "S": F.col("species")}.get(c, none).alias(c) for c in S.RANKS])
    word = F.element_at(F.array(*[F.lit(w) for w in ("true", " Yes", "Y ", "1", "false", "NO", "n", " 0 ")]), (F.col("p_partkey") % 8 + 1).cast("int"))
    found = rows.withColumn("x", S.species_complex(path))
    return found.select("p_partkey", S.tool_number(F.col("said")).alias("number"), S.percent(F.col("share")).alias("percent"), S.last_bases(F.col("long")).alias("last"), S.flag(word).alias("flag"), F.col("x.G").alias("genus"), F.col("x.S").alias("species"))


@query("WITH " + Q._pool.format(part="part") + " SELECT primer_id, gene, forward, reverse FROM (SELECT primer_id, CAST(gene_idx AS VARCHAR) AS gene, fwd AS forward, rev AS reverse FROM pr UNION ALL VALUES ('adapter', 'adapter', 'ACGTTT', 'GGGAAA'), ('linker', 'linker', 'CCCTTT', 'AAAGGG'))")
def q82_candidate_table(spark, sf_dir):
    """Candidates behind two fixed pairs, as they are listed and written."""

    def make() -> str:
        folder = fresh_path(spark, "candidates")
        primers.write_candidates(primers.with_fixed(Q._pool_df(spark, sf_dir).drop("pool"), [("adapter", "ACGTTT", "GGGAAA"), ("linker", "CCCTTT", "AAAGGG")]), folder)
        return folder

    own = spark.read.option("sep", "\t").option("header", True).csv(_once(spark, sf_dir, "written-candidates", make) + "/primers.tsv")
    return own.select("primer_id", "gene", "forward", "reverse")


# ---- a landing folder
@query(Q._with(Q._found, """SELECT 'reason' AS kind, coalesce(qc_reason, 'passed') AS key, count(*) AS n, NULL AS first_index FROM qc GROUP BY ALL
 UNION ALL SELECT 'start', CAST(start AS VARCHAR), count(*), NULL FROM pq WHERE start IS NOT NULL GROUP BY ALL
 UNION ALL SELECT 'barcode', code, count(*), CAST(arg_min(read_index, CASE WHEN pix = 0 THEN 0 WHEN pix > 0 THEN 1 ELSE 2 END * 1000000000 + read_index) AS BIGINT) FROM pq GROUP BY code"""))
def q83_running_counts(spark, sf_dir):
    """Counts of reads that land in five files, two calls of the stream apart; a barcode's first read is the one that clustering orders it by."""
    from tessera.streaming import reads

    def make() -> str:
        folder = fresh_path(spark, "landing")
        own = surrogate.reads(spark, sf_dir).select("read_index", "read_id", F.col("fq1").alias("r1_seq"), F.col("q1").alias("r1_qual"), F.col("fq2").alias("r2_seq"), F.col("q2").alias("r2_qual"))
        for k in range(5):
            own.where(F.pmod(F.xxhash64("read_index"), F.lit(5)) == k).coalesce(1).write.parquet(f"{folder}/in/{k}")
            if k in (1, 4):
                stream = spark.readStream.schema(reads.PAIRS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
                reads.running_counts(stream, PANEL, f"{folder}/counts", f"{folder}/checkpoint")
        return f"{folder}/counts"

    own = reads.counts_now(spark, _once(spark, sf_dir, "landing", make))
    return own.select("kind", "key", "n", F.when(F.col("kind") == "barcode", F.col("first.index")).alias("first_index"))
