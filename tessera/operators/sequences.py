"""Target sequences: reconstruction, consensus, naming, denoising, repeats, reference matches."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import seq as S
from tessera.functions import stats
from tessera.functions.automaton import Automaton
from tessera.functions.kernels import Texts
from tessera.operators.order import numbered_in
from tessera.params import Consensus, Targets
from tessera.storage import stored

CORE = "struct<r1:string,r2:string>"


def target_cores(packets: DataFrame, p: Targets = Targets()) -> DataFrame:
    """(cell, target, core, n, first): target reads by core sequence."""
    core = S.core(F.col("r1_seq"), F.col("r2_seq"), p.r1, p.r2)
    reads = packets.where("gene_class = 'target'").withColumn("core", core).where("core is not null")
    return reads.groupBy("cell", "target", "core").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("barcode_ord", "read_index")).alias("first"))


def cluster_cores(counts: DataFrame, p: Targets = Targets(), guard: str = "all_dominants") -> DataFrame:
    """(target, core, dominant): each distinct core's representative.

    Cores of a target come by reads, then first seen.  One joins the first dominant core
    within the distance, provided that it is as near to every dominant core of the target so
    far (guard "all_dominants") or to the members of that cluster ("cluster").

    With the first guard what joins is near every dominant core before it, so that it joins
    the first of all.  Each target's dominant cores are held against what is still open, one
    a round: what is far from one becomes dominant itself, what has no dominant core left
    before it has joined.  A round's join has one row a target of the panel.
    """
    own = counts.groupBy("target", "core").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    own = own.select("target", "core", F.struct((-F.col("n")).alias("n"), "first", "core").alias("ord"))
    if guard == "cluster":
        return _cluster_by_members(own, p)
    own = stored(own, "cores")
    top = own.groupBy("target").agg(F.min("ord").alias("first"))
    top = stored(top.select("target", F.col("first.core").alias("head"), F.col("first").alias("last")), "heads")
    # "last": the place of the last dominant core that a target's open cores were held against
    open_, heads, last = own.join(F.broadcast(top), "target").where(F.col("ord") > F.col("last")).select("target", "core", "ord", "head"), [top.select("target", F.col("head").alias("core"))], top.select("target", "last")
    known = None
    while True:
        judged = stored(open_.withColumn("far", S.pair_distance(F.col("core"), F.col("head"), p.max_shift) > p.max_mismatches), "judged")
        new = judged.where("far").select("target", "core", "ord")
        heads.append(new.select("target", "core"))
        known = new if known is None else known.unionByName(new)
        following = known.join(F.broadcast(last), "target").where(F.col("ord") > F.col("last")).groupBy("target").agg(F.min("ord").alias("last"))
        last = stored(following, "last")
        rest = judged.where("not far").select("target", "core", "ord").join(F.broadcast(last), "target").where(F.col("ord") > F.col("last"))
        open_ = rest.select("target", "core", "ord", F.col("last.core").alias("head"))
        if open_.isEmpty():
            break
    dominant = reduce(DataFrame.unionByName, heads).withColumn("dominant", F.col("core"))
    joined = own.join(dominant.select("target", "core", "dominant"), ["target", "core"], "left").join(F.broadcast(top.select("target", "head")), "target")
    return joined.select("target", "core", F.coalesce("dominant", "head").alias("dominant"))


def _cluster_by_members(own: DataFrame, p: Targets) -> DataFrame:
    """cluster_cores() with the guard over a cluster's own members; a function call holds the distinct cores of one target."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", kind="stable")
        cores = Texts(pa.array(pdf["r1"], pa.string()), pa.array(pdf["r2"], pa.string()))
        near = lambda k, others: cores.apart(np.full(len(others), k), np.array(others), p.max_shift) <= p.max_mismatches
        members: dict[int, list[int]] = {}
        owner = []
        for k in range(len(pdf)):
            # all dominant cores at once, then all members of the first that is near
            heads = list(members)
            hit = near(k, heads) if heads else np.zeros(0, bool)
            first = heads[int(np.argmax(hit))] if hit.any() else k
            if first != k and not near(k, members[first]).all():
                first = k
            members.setdefault(first, []).append(k)
            owner.append(first)
        head = pdf.iloc[owner]
        return pd.DataFrame({"target": pdf["target"].to_numpy(), "r1": pdf["r1"].to_numpy(), "r2": pdf["r2"].to_numpy(), "d1": head["r1"].to_numpy(), "d2": head["r2"].to_numpy()})

    ranked = numbered_in(own, "target", ["ord"], "rank").select("target", "core.r1", "core.r2", "rank")
    found = ranked.groupBy("target").applyInPandas(fold, "target string, r1 string, r2 string, d1 string, d2 string")
    return found.select("target", F.struct("r1", "r2").alias("core"), F.struct(F.col("d1").alias("r1"), F.col("d2").alias("r2")).alias("dominant"))


def call_sequences(counts: DataFrame, clusters: DataFrame, p: Consensus = Consensus()) -> DataFrame:
    """(cell, target, core, confidence, contamination, total, noise): a cell's sequence of a target, null where it stays open."""
    joined = counts.join(clusters, ["target", "core"]).groupBy("cell", "target", F.col("dominant").alias("core")).agg(F.sum("n").alias("n"))
    cells = joined.groupBy("cell", "target").agg(F.collect_list(F.struct(F.col("core").alias("v"), F.col("n"))).alias("counts"), F.sum("n").alias("total"))
    out = cells.withColumn("call", stats.sequence_consensus(F.col("counts"), p))
    split = stats.noise_split(F.col("counts"), F.col("call.v"), F.col("total"), p)
    known = F.col("call.v").isNotNull()
    out = out.withColumn("split", split)
    return out.select("cell", "target", F.col("call.v").alias("core"), F.when(known, F.col("call.confidence")).alias("confidence"), F.when(known, stats.contamination_mean(F.col("split.contam"), F.col("split.match"), F.col("split.noise"), p)).alias("contamination"), "total", F.when(known, F.col("split.noise")).otherwise(0).alias("noise"))


def name_sequences(calls: DataFrame, place: DataFrame) -> DataFrame:
    """(target, seq_no, sequence_id, core, cells): cores by number of cells, ties by the first cell's place; place: (cell, place)."""
    counted = calls.where("core is not null").join(place, "cell").groupBy("target", "core").agg(F.count(F.lit(1)).alias("cells"), F.min("place").alias("place"))
    return numbered_in(counted, "target", [F.desc("cells"), "place", "core"], "seq_no").select("target", "seq_no", F.concat("target", F.lit("_seq_"), F.col("seq_no").cast("string")).alias("sequence_id"), "core", "cells")


def poisson_sf(k: float, rate: float) -> float:
    """P(X > k)."""
    if k < 0:
        return 1.0
    term = total = math.exp(-rate)
    for m in range(1, int(k) + 1):
        term *= rate / m
        total += term
    return max(0.0, 1.0 - total)


def poisson_ppf(q: float, rate: float) -> float:
    """The least k with P(X <= k) >= q."""
    term = total = math.exp(-rate)
    k = 0
    while total < q and k < 10_000_000:
        k += 1
        term *= rate / k
        total += term
    return float(k)


def fit_decay(x: np.ndarray, y: np.ndarray, rounds: int = 10_000) -> tuple[float, float, float] | None:
    """Least squares of a * exp(-b x) + c by damped Gauss-Newton steps from (max, 0.5, min); None where it doesn't settle."""
    p = np.array([y.max(), 0.5, y.min()], float)
    damping = 1e-3
    with np.errstate(all="ignore"):
        residual = p[0] * np.exp(-p[1] * x) + p[2] - y
        cost = residual @ residual
        for _ in range(rounds):
            e = np.exp(-p[1] * x)
            j = np.stack([e, -p[0] * x * e, np.ones_like(e)], 1)
            a, g = j.T @ j, j.T @ residual
            try:
                step = np.linalg.solve(a + damping * np.diag(np.maximum(np.diag(a), 1e-12)), -g)
            except np.linalg.LinAlgError:
                return None
            q = p + step
            r = q[0] * np.exp(-q[1] * x) + q[2] - y
            c = r @ r
            if np.isfinite(c) and c <= cost:
                done = np.abs(step).max() <= 1e-10 * (1 + np.abs(p).max()) or cost - c <= 1e-14 * (1 + cost)
                p, residual, cost, damping = q, r, c, max(1e-12, damping / 10)
                if done:
                    return tuple(p)
            else:
                damping *= 10
                if damping > 1e16:
                    return tuple(p) if np.isfinite(cost) else None
    return None


def retained(counts: list[int], noise_rate: float, alpha: float) -> int:
    """How many of a target's sequences stay, counts in descending order."""
    if len(counts) < 2:
        return len(counts)
    c = np.array(counts, float)
    rate = c[0] * noise_rate
    cut = poisson_ppf(1 - alpha, rate) + 1
    tail = [i for i in range(1, len(c)) if c[i] < cut]
    if len(tail) < 4:
        tail = list(range(max(1, len(c) // 2), len(c)))
    fit = fit_decay(np.array(tail, float), c[tail]) if len(tail) >= 3 else None
    decay = (lambda x: fit[0] * np.exp(-fit[1] * x) + fit[2]) if fit else None
    spread = float(np.std(c[tail] - decay(np.array(tail, float)))) if fit else 0.0
    kept = 1
    while kept < len(c):
        if poisson_sf(c[kept] - 1, rate) >= alpha:
            break
        if decay is not None and c[kept] <= decay(kept) + max(3 * spread, 0.5 * decay(kept)):
            break
        kept += 1
    return kept


def denoise(names: DataFrame, p: Targets = Targets()) -> DataFrame:
    """names with retained: sequences that rise above their target's noise.

    The noise rate is the second over the first cell count of the control target; without
    one only the decay of a target's own tail counts.  A function call holds one target's
    counts; ties are in the order of seq_no.
    """
    top = names.where(F.lower("target") == p.control).select("cells").orderBy(F.desc("cells")).limit(2).collect()
    rate = top[1]["cells"] / top[0]["cells"] if len(top) > 1 else 0.0

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cells", "seq_no"], ascending=[False, True])
        stay = retained(pdf["cells"].tolist(), rate, p.sequence_alpha)
        return pd.DataFrame({"target": pdf["target"], "seq_no": pdf["seq_no"], "retained": np.arange(len(pdf)) < stay})

    kept = names.select("target", "seq_no", "cells").groupBy("target").applyInPandas(fold, "target string, seq_no int, retained boolean")
    return names.join(kept, ["target", "seq_no"])


def assignments(filtered: DataFrame, calls: DataFrame, names: DataFrame, eligible: list[str]) -> DataFrame:
    """(cell, target, n, filtered, assignment_type, sequence_id) of each target of a cell.

    names: with retained.  A sequence that isn't retained falls back to its parent; targets
    that aren't eligible for reconstruction are only detected.
    """
    named = calls.join(names.where("retained").select("target", "core", "sequence_id"), ["target", "core"], "left").select("cell", "target", "sequence_id")
    out = filtered.join(named, ["cell", "target"], "left")
    kind = F.when(F.col("filtered") == 0, "filtered_out").when(~F.col("target").isin(*eligible) if eligible else F.lit(True), "detected").when(F.col("sequence_id").isNull(), "sequence_unresolved").otherwise("sequence_cluster")
    out = out.withColumn("assignment_type", kind)
    return out.select("cell", "target", "n", "filtered", "assignment_type", F.when(F.col("assignment_type") == "sequence_cluster", F.col("sequence_id")).alias("sequence_id"))


REPEAT = T.ArrayType(T.StructType([T.StructField("motif", T.StringType()), T.StructField("repeat_count", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def tandem_repeats(sequence: str) -> list[tuple[str, int, int, int]]:
    """Greedy from the left: at each place the longest span of two or more copies, the shorter motif on ties."""
    out, i, n = [], 0, len(sequence)
    while i < n:
        span, best = 0, None
        for size in range(1, (n - i) // 2 + 1):
            motif, end = sequence[i : i + size], i + size
            while sequence.startswith(motif, end):
                end += size
            if end - i >= 2 * size and end - i > span:
                span, best = end - i, (motif, (end - i) // size, i, end)
        if best is None:
            i += 1
        else:
            out.append(best)
            i = best[3]
    return out


@F.pandas_udf(REPEAT)
def find_repeats(sequences: pd.Series) -> pd.Series:
    return sequences.map(lambda s: [dict(zip(("motif", "repeat_count", "start", "end"), r)) for r in tandem_repeats(s)] if s is not None else None)


def phase_calls(names: DataFrame, modes: DataFrame) -> DataFrame:
    """A call for each sequence of an ssr target: the longest tandem repeat of R1 and R2's reverse complement, the first on ties.

    names and modes: (target, ...) and (target, mode).
    """
    own = names.join(F.broadcast(modes.where("mode = 'ssr'").select("target", "mode")), "target")
    found = own.withColumn("repeats", find_repeats(F.concat("core.r1", S.reverse_complement(F.col("core.r2")))))
    best = F.array_max(F.transform("repeats", lambda r: F.struct((r["end"] - r["start"]).alias("span"), (-r["start"]).alias("k"), r.alias("r"))))["r"]
    out = found.withColumn("best", best)
    return out.select("target", "sequence_id", "mode", F.when(F.col("best").isNotNull(), "ssr_detected").otherwise("no_ssr_detected").alias("call"), "best.motif", "best.repeat_count", "best.start", "best.end", F.lit(None).cast("double").alias("direct_similarity"), F.lit("tandem_repeat_scan").alias("evidence"))


#: Bases of a subject that are one row, bases of the patterns of one automaton, and bases of the stretches that one task takes.
STRETCH, PATTERNS, SUBJECTS = 1 << 20, 1 << 21, 1 << 26


def stretches(reference: DataFrame, overlap: int, size: int = STRETCH) -> DataFrame:
    """(subject, title, start from 0, bases) of a reference's subjects (name, title, seq): each stretch has overlap bases of the next one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(2)[k].as_py() or ""
                for start in range(0, max(1, len(text) - overlap), size):
                    part = text[start : start + size + overlap].encode("latin-1", "replace")
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([start]), pa.array([part])], names=["subject", "title", "start", "bases"])

    own = reference.select(F.xxhash64("name", "title", "seq").alias("subject"), F.col("title").cast("string").alias("title"), "seq")
    return own.mapInArrow(cut, "subject long, title string, start long, bases binary")


def places(patterns: DataFrame, reference: DataFrame, size: int = STRETCH, bases: int = PATTERNS, together: int = SUBJECTS) -> DataFrame:
    """(pattern, subject, title, place): where distinct patterns (pattern) first stand in subjects, counted from 1.

    Patterns are dealt into blocks of about `bases`, each an automaton, and stretches into
    groups of about `together`; a task has one of each.
    """
    told = patterns.agg(F.max(F.length("pattern")).alias("longest"), F.sum(F.length("pattern")).alias("all")).first()
    longest, blocks = told["longest"] or 1, max(1, -(-(told["all"] or 0) // bases))
    groups = max(1, -(-(reference.agg(F.sum(F.length("seq"))).first()[0] or 0) // together))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = patterns.select(F.pmod(F.xxhash64("pattern"), F.lit(blocks)).cast("int").alias("b"), every(groups).alias("g"), "pattern")
    right = stretches(reference, longest - 1, size).select(every(blocks).alias("b"), F.pmod(F.xxhash64("subject", "start"), F.lit(groups)).cast("int").alias("g"), "subject", "title", "start", "bases")

    def look(own: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(texts):
            return pd.DataFrame({"pattern": pd.Series(dtype=str), "subject": pd.Series(dtype="int64"), "title": pd.Series(dtype=str), "place": pd.Series(dtype="int64")})
        pattern = own["pattern"].to_numpy()
        text, which, at = Automaton([p.encode("latin-1", "replace") for p in pattern]).first_places([bytes(b) for b in texts["bases"]])
        of = texts.iloc[text]
        return pd.DataFrame({"pattern": pattern[which], "subject": of["subject"].to_numpy(), "title": of["title"].to_numpy(), "place": of["start"].to_numpy() + at + 1})

    found = left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInPandas(look, "pattern string, subject long, title string, place long")
    return found.groupBy("pattern", "subject", "title").agg(F.min("place").cast("int").alias("place"))


def reference_matches(names: DataFrame, reference: DataFrame, **sizes: int) -> DataFrame:
    """(sequence_id, subject, r1_start, r1_end, r2_start, r2_end): subjects that hold both mates whole, on either strand.

    Places are counted from 1; of several, the first on the given strand, else on the other.
    All mates and their reverse complements are looked up at once: see places().  An empty
    mate is in no subject; subjects of equal name, title and bases are one.
    """
    both = names.select("sequence_id", F.col("core.r1").alias("q1"), F.col("core.r2").alias("q2")).where("length(q1) > 0 and length(q2) > 0")
    asked = both.select("sequence_id", *[F.struct(F.col(q).alias("given"), S.reverse_complement(F.col(q)).alias("other")).alias(q) for q in ("q1", "q2")])
    ways = [F.struct(F.lit(f"{q}_{way}").alias("way"), F.col(f"{q}.{way}").alias("pattern")) for q in ("q1", "q2") for way in ("given", "other")]
    wanted = stored(asked.select("sequence_id", F.explode(F.array(*ways)).alias("w")).select("sequence_id", "w.way", "w.pattern"), "mates")
    met = places(wanted.select("pattern").distinct(), reference, **sizes).join(wanted, "pattern")
    start = lambda q: F.coalesce(*[F.min(F.when(F.col("way") == f"{q}_{way}", F.col("place"))) for way in ("given", "other")])
    out = met.groupBy("sequence_id", "subject", "title").agg(start("q1").alias("r1_start"), start("q2").alias("r2_start")).where("r1_start is not null and r2_start is not null")
    out = out.join(both, "sequence_id")
    return out.select("sequence_id", F.col("title").alias("subject"), "r1_start", (F.col("r1_start") + F.length("q1") - 1).alias("r1_end"), "r2_start", (F.col("r2_start") + F.length("q2") - 1).alias("r2_end"), F.lit(100.0).alias("percent_identity"))
