"""Choosing primer pools: candidates, dimer scores, annealing."""

from __future__ import annotations

import functools
import re
import shutil
import subprocess
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import duplex
from tessera.sources.tables import write_tsv
from tessera.storage import stored

# The design tool's keys and parameters, and the dimer tool's, below.
#: What is left of an oligo for a tool that takes 60 bases.
OLIGO = 60
SETTINGS = {"opt_tm": 60, "min_tm": 55, "max_tm": 63, "opt_size": 20, "min_size": 18, "max_size": 25, "max_end_gc": 2, "max_gc": 50, "product": "400-500", "number": 100}


def boulder(name: str, seq: str, s: dict = SETTINGS) -> str:
    """A primer design request."""
    lines = {
        "SEQUENCE_ID": name, "SEQUENCE_TEMPLATE": seq, "PRIMER_TASK": "generic", "PRIMER_OPT_TM": s["opt_tm"], "PRIMER_MIN_TM": s["min_tm"], "PRIMER_MAX_TM": s["max_tm"],
        "PRIMER_OPT_SIZE": s["opt_size"], "PRIMER_MIN_SIZE": s["min_size"], "PRIMER_MAX_SIZE": s["max_size"], "PRIMER_MAX_END_GC": s["max_end_gc"], "PRIMER_MAX_GC": s["max_gc"],
        "PRIMER_SALT_DIVALENT": 2, "PRIMER_SALT_MONOVALENT": 100, "PRIMER_PRODUCT_SIZE_RANGE": s["product"], "PRIMER_NUM_RETURN": s["number"]}
    return "".join(f"{k}={v}\n" for k, v in lines.items()) + "=\n"


def parse_boulder(text: str) -> list[tuple]:
    """(number, left, right, left's and right's melting points, the product's size) of a design tool's answer; null what it doesn't say."""
    said = dict(line.split("=", 1) for line in text.splitlines() if "=" in line and not line.startswith("="))
    number = lambda key, kind: kind(said[key]) if key in said else None
    out, k = [], 0
    while f"PRIMER_LEFT_{k}_SEQUENCE" in said:
        details = number(f"PRIMER_LEFT_{k}_TM", float), number(f"PRIMER_RIGHT_{k}_TM", float), number(f"PRIMER_PAIR_{k}_PRODUCT_SIZE", int)
        out.append((k, said[f"PRIMER_LEFT_{k}_SEQUENCE"], said[f"PRIMER_RIGHT_{k}_SEQUENCE"], *details))
        k += 1
    return out


CANDIDATES = "gene_idx int, gene string, primer_id string, fwd string, rev string"
DESIGNED = CANDIDATES + ", forward_tm double, reverse_tm double, amplicon_len int"


def design(targets: DataFrame, tool: str = "primer3_core") -> DataFrame:
    """Candidates of each target (gene_idx, name, seq) from a design tool on the executors' path; without one, ingest a table instead."""
    if shutil.which(tool) is None:
        raise FileNotFoundError(f"{tool} isn't installed; read a candidate table (gene_idx, gene, primer_id, fwd, rev)")

    def run(batches):
        for pdf in batches:
            rows = []
            for g, name, seq in zip(pdf["gene_idx"], pdf["name"], pdf["seq"]):
                answer = subprocess.run([tool], input=boulder(name, seq), capture_output=True, text=True, check=True).stdout
                rows += [(g, name, f"{name}_{k}", *rest) for k, *rest in parse_boulder(answer)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in DESIGNED.split(", ")])

    return targets.select("gene_idx", "name", "seq").mapInPandas(run, DESIGNED)


def with_fixed(candidates: DataFrame, fixed: list[tuple[str, str, str]]) -> DataFrame:
    """candidates behind fixed pairs (name, fwd, rev), each a gene of one pair."""
    first = candidates.sparkSession.createDataFrame([(k, n, n, f, r) for k, (n, f, r) in enumerate(fixed)], CANDIDATES)
    return first.unionByName(candidates.withColumn("gene_idx", F.col("gene_idx") + len(fixed)), allowMissingColumns=True)


def fasta_lines(candidates: DataFrame) -> DataFrame:
    """Two FASTA records a pair, for writing as text."""
    return candidates.select(F.explode(F.array(F.concat(F.lit(">"), "primer_id", F.lit("-f\n"), "fwd"), F.concat(F.lit(">"), "primer_id", F.lit("-r\n"), "rev"))).alias("value"))


def candidate_table(candidates: DataFrame) -> DataFrame:
    """Candidates as they are listed for people, genes in order; melting points and sizes are null where they aren't known."""
    detail = lambda c, kind: F.col(c) if c in candidates.columns else F.lit(None).cast(kind).alias(c)
    return candidates.orderBy("gene_idx", "primer_id").select("primer_id", "gene", F.col("fwd").alias("forward"), F.col("rev").alias("reverse"), detail("forward_tm", "double"), detail("reverse_tm", "double"), detail("amplicon_len", "int"))


def write_candidates(candidates: DataFrame, folder: str) -> None:
    """primers.fasta, primers.tsv, and primers.parquet, which reads back as it was, below a folder."""
    fasta_lines(candidates).write.text(f"{folder}/primers.fasta")
    write_tsv(candidate_table(candidates), f"{folder}/primers.tsv")
    candidates.write.parquet(f"{folder}/primers.parquet")


def parse_energy(text: str) -> float:
    """The 14th word of a dimer tool's answer as a number, else the first number in it."""
    words = text.split()
    try:
        return float(words[13])
    except (IndexError, ValueError):
        found = re.search(r"-?\d+(?:\.\d+)?", text)
        if not found:
            raise ValueError(f"no energy in {text!r}") from None
        return float(found[0])


def tool_energy(tool: str = "ntthal"):
    """Energies for dimer_scores() from a dimer tool on the executors' path: the lower one of both ends' alignments."""

    def energy(a: str, b: str) -> float:
        ask = lambda end: subprocess.run([tool, "-mv", "200", "-dv", "3", "-n", "0.2", "-t", "25", "-d", "50", "-s1", a[-OLIGO:], "-s2", b[-OLIGO:], "-a", end], capture_output=True, text=True, check=True).stdout
        return min(parse_energy(ask(end)) for end in ("END1", "END2"))

    return lambda xs, ys: np.array([min(energy(x, y), energy(y, x)) for x, y in zip(xs, ys)])


def dimer_energies(xs: list[str], ys: list[str], below: np.ndarray | None = None) -> np.ndarray:
    """The lowest energy, in kcal/mol, at which the 3' end of either of two oligos binds the other: stacks, bulges, internal loops, ends and salt; see duplex.

    below: bounds; what isn't lower than its bound may come out as any energy that isn't.
    """
    below = None if below is None else np.rint(below * 1000).astype(np.int64)
    return duplex.energies([x[-OLIGO:] for x in xs], [y[-OLIGO:] for y in ys], below=below) / 1000


#: That energies take bounds.
dimer_energies.bounded = True


def dimer_energy(a: str, b: str) -> float:
    """dimer_energies() of one pair."""
    return float(dimer_energies([a], [b])[0])


def equal_places(xs: list[str], ys: list[str]) -> np.ndarray:
    """A plain stand-in for an energy: minus the places at which two oligos have the same base."""
    size = max(map(len, [*xs, *ys]), default=0)
    table = lambda own, pad: np.frombuffer("".join(o.ljust(size, pad) for o in own).encode(), np.uint8).reshape(len(own), size)
    return -(table(xs, "<") == table(ys, ">")).sum(1).astype(float)


def candidate_pairs(candidates: DataFrame, pool: str | None = None, tail: int = OLIGO) -> DataFrame:
    """(pool, id_lo, id_hi, o0, o1, o2, o3): pairs of candidates of different genes, with the last `tail` bases of their four oligos; the lower one of their own energies, where candidates have them.

    Genes are ordered, so that a pair comes once.  pool: a column of candidates that are
    pooled apart; only pairs of one pool meet, by an equi-join.  A pool's candidates are some
    hundred a gene.
    """
    pool_ = F.col(f"`{pool}`") if pool else F.lit(0)
    ends = lambda c: F.expr(f"right({c}, {min(tail, OLIGO)})")
    own = lambda c: [F.col("own").alias(c)] if "own" in candidates.columns else []
    a = candidates.select(pool_.alias("pool"), F.col("gene_idx").alias("ga"), F.col("primer_id").alias("ia"), ends("fwd").alias("o0"), ends("rev").alias("o1"), *own("wa"))
    b = candidates.select(pool_.alias("pool"), F.col("gene_idx").alias("gb"), F.col("primer_id").alias("ib"), ends("fwd").alias("o2"), ends("rev").alias("o3"), *own("wb"))
    lower = [F.least("wa", "wb").alias("own")] if own("wa") else []
    return a.join(b, "pool").where("ga < gb").select("pool", F.least("ia", "ib").alias("id_lo"), F.greatest("ia", "ib").alias("id_hi"), "o0", "o1", "o2", "o3", *lower)


def lowest_energies(oligos: list[pd.Series], energies, twos: list[tuple[int, int]], so_far: np.ndarray | None = None) -> np.ndarray:
    """For each row of several columns of oligos the lowest energy of the named two columns, and of what is known so far; what is the same two in many rows is worked out once."""
    number, names = pd.factorize(pd.concat(oligos, ignore_index=True))
    number = number.reshape(len(oligos), -1)
    best = np.full(number.shape[1], np.inf) if so_far is None else np.asarray(so_far, float)
    for i, j in twos:
        two = np.minimum(number[i], number[j]) * len(names) + np.maximum(number[i], number[j])
        distinct, of = np.unique(two, return_inverse=True)
        pair = [names.take(k).tolist() for k in (distinct // len(names), distinct % len(names))]
        if getattr(energies, "bounded", False) and np.isfinite(best).all():
            # the highest of its rows' bounds
            below = np.full(len(distinct), -np.inf)
            np.maximum.at(below, of, best)
            found = energies(*pair, below)
        else:
            found = energies(*pair)
        best = np.minimum(best, np.asarray(found, float)[of])
    return best


def _parts(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def dimer_scores(candidates: DataFrame, energies=dimer_energies, pool: str | None = None, tail: int = OLIGO) -> DataFrame:
    """(id_lo, id_hi, delta_g), led by the pool where there are some: the lowest energy over all bindings.

    energies: of two lists of oligos, the same in either order.  A candidate's oligos are
    scored with themselves and with each other first.  Pairs are scored where the join makes
    them, a batch at a time, each distinct two oligos of a batch once; energies that take
    bounds are only asked for what is lower than a pair's lowest one so far.
    """

    @F.pandas_udf("double")
    def alone(o0: pd.Series, o1: pd.Series) -> pd.Series:
        return pd.Series(lowest_energies([o0, o1], energies, [(0, 0), (0, 1), (1, 1)]) if len(o0) else np.zeros(0))

    @F.pandas_udf("double")
    def score(o0: pd.Series, o1: pd.Series, o2: pd.Series, o3: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series(lowest_energies([o0, o1, o2, o3], energies, [(0, 2), (0, 3), (1, 2), (1, 3)], own.to_numpy()) if len(o0) else np.zeros(0))

    # numbers of parts of their own: by their bytes, which are few, so much work would be dealt out to a task or two
    parts, ends = _parts(candidates.sparkSession), lambda c: F.expr(f"right({c}, {min(tail, OLIGO)})")
    own = candidates.select(*([pool] if pool else []), "gene_idx", "primer_id", "fwd", "rev").repartition(parts, "primer_id")
    own = stored(own.withColumn("own", alone(ends("fwd"), ends("rev"))), "own-energies")
    dealt = candidate_pairs(own, pool, tail).repartition(parts, "pool", "id_lo")
    scored = dealt.select("pool", "id_lo", "id_hi", score("o0", "o1", "o2", "o3", "own").alias("delta_g"))
    return scored.withColumnRenamed("pool", pool) if pool else scored.drop("pool")


def pool_score(chosen: DataFrame, scores: DataFrame) -> DataFrame:
    """(avg_score, min_score, rank_score) of a set of pairs (primer_id)."""
    a, b = chosen.select(F.col("primer_id").alias("id_lo")), chosen.select(F.col("primer_id").alias("id_hi"))
    own = scores.join(a, "id_lo", "left_semi").join(b, "id_hi", "left_semi")
    return own.agg(F.avg("delta_g").alias("avg_score"), F.min("delta_g").alias("min_score")).withColumn("rank_score", F.col("avg_score") + F.col("min_score"))


#: Chains that go in step in one task, and candidates of a pool, at most: a task holds a matrix of their scores.
CHAINS, POOL = 200, 8192
#: Pools whose chains go in step, scores that they have together, at most; candidates that are dealt to a task's call together, about.
IN_STEP, SCORES, DEALT = 16, 1 << 24, 1600
#: What scores are multiples of while chains compare them, so that sums don't depend on their order.
UNIT = 1000


def draws(seed: int, chain: int, genes: int, cycles: int) -> tuple[np.ndarray, np.ndarray]:
    """A chain's random numbers: one for each gene's first candidate; for each step whether any pair may go, which one, for which, and whether a worse set stays."""
    rng = np.random.default_rng([seed, chain])
    return rng.random(genes), rng.random((cycles, 4))


@functools.lru_cache(maxsize=2)
def _all_draws(seed: int, chains: tuple[int, ...], genes: int, cycles: int) -> tuple[np.ndarray, np.ndarray]:
    """draws() of many chains: (gene, chain), and (step, what, chain); the same for every pool."""
    began, steps = zip(*[draws(seed, c, genes, cycles) for c in chains])
    return np.stack(began, 1), np.ascontiguousarray(np.stack(steps).transpose(1, 2, 0))


def anneal(genes: list[np.ndarray], scores: np.ndarray, fixed: int, cycles: int, temperature: float, beta: float, seed: int, chains: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chains in step: (rank, average, minimum, candidates by gene) of the best set that each one proposed.

    genes: their candidates' numbers; scores: a symmetric matrix of whole numbers of UNIT-ths.
    """
    return anneal_pools([(genes, scores)], fixed, cycles, temperature, beta, seed, chains)[0]


def anneal_pools(pools: list[tuple[list[np.ndarray], np.ndarray]], fixed: int, cycles: int, temperature: float, beta: float, seed: int, chains: list[int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """anneal() of several pools of as many genes, whose chains all go in step; each pool's chains draw the same numbers.

    Four of five steps replace the changeable pair with the lowest row sum, the others any;
    a set is kept if its energy, minus the average score, falls, else by chance.  A step
    changes one row and one column of a set's scores, and so the row sums by their
    difference; the minimum is only looked up for sets whose average could be the best.
    """
    count, n, many = len(chains), len(pools[0][0]), len(pools)
    pairs = max(1, n * (n - 1) // 2)
    began, steps = _all_draws(seed, tuple(chains), n, cycles)
    sizes = np.array([[len(g) for g in genes] for genes, _ in pools])
    widest = sizes.max()
    table = np.zeros((many, n, widest), np.int64)
    for p, (genes, _) in enumerate(pools):
        for k, g in enumerate(genes):
            table[p, k, : len(g)] = g
    # a column for each chain of each pool; where its pool's genes, their sizes and its scores begin, and how long a row of scores is
    flat = np.concatenate([s.ravel() for _, s in pools])
    pool, row = np.repeat(np.arange(many), count), np.arange(many * count)
    wide = np.array([len(s) for _, s in pools])
    begin, wide = (np.cumsum(wide**2) - wide**2)[pool], wide[pool]
    sizes, table, place = sizes.ravel(), table.ravel(), pool * n
    own, none = np.arange(n)[:, None], np.iinfo(np.int64).max
    at = place + own
    chosen = table[at * widest + (np.tile(began, many) * sizes[at]).astype(int)]

    def between(sets: np.ndarray, of: np.ndarray) -> np.ndarray:
        """(gene, gene, set): scores of sets that are columns of the chains `of`."""
        return flat[begin[of] + sets[:, None] * wide[of] + sets[None]].astype(np.int64)

    def lowest(sets: np.ndarray, of: np.ndarray) -> np.ndarray:
        values = between(sets, of)
        values[np.arange(n), np.arange(n)] = values.max(initial=0) if n < 2 else none
        return values.min((0, 1))

    first = between(chosen, row)
    first[np.arange(n), np.arange(n)] = 0
    sums = first.sum(0)
    total = sums.sum(0) // 2
    best_total, best_low, best = total.copy(), lowest(chosen, row), chosen.copy()
    rank = lambda sum_, low: sum_ / pairs + low
    best_rank = rank(best_total, best_low)
    for turn in range(cycles if n > max(1, fixed) else 0):
        any_, which, with_, stay = np.tile(steps[turn], many)
        k = np.where(any_ >= 0.2, fixed + np.argmin(sums[fixed:], axis=0), fixed + (which * (n - fixed)).astype(int))
        new = table[(place + k) * widest + (with_ * sizes[place + k]).astype(int)]
        old, was = chosen[k, row], sums[k, row]
        line = flat.take(begin + new * wide + chosen).astype(np.int64)
        # a proposed set's minimum is at most that of its new row
        line[k, row] = none
        line_low = line.min(0)
        line[k, row] = 0
        now = line.sum(0)
        change = now - was
        rise = -change / pairs / UNIT
        taken = change > 0
        if temperature > 0:
            taken |= np.exp(-np.maximum(rise, 0) / temperature) > stay
        hope = np.flatnonzero(rank(total + change, line_low) > best_rank)
        if len(hope):
            sets = chosen[:, hope]
            sets[k[hope], np.arange(len(hope))] = new[hope]
            low = lowest(sets, hope)
            found = rank(total[hope] + change[hope], low)
            better = found > best_rank[hope]
            at = hope[better]
            best[:, at], best_rank[at], best_low[at], best_total[at] = sets[:, better], found[better], low[better], total[at] + change[at]
        line -= flat.take(begin + old * wide + chosen)
        line[k, row] = change
        sums += line * taken
        total += change * taken
        chosen[k, row] = np.where(taken, new, old)
        if (turn + 1) % 100 == 0:
            temperature *= beta
    out = best_rank / UNIT, best_total / pairs / UNIT, best_low / UNIT, best.T
    return [tuple(values[p * count : (p + 1) * count] for values in out) for p in range(many)]


def _scored(own: pd.DataFrame, known: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """A pool's candidates in order, their numbers by gene, and the matrix of their scores."""
    own = own.sort_values(["gene_idx", "primer_id"], kind="stable").reset_index(drop=True)
    number = pd.Series(own.index, own["primer_id"])
    number = number[~number.index.duplicated()]
    a, b = number.reindex(known["id_lo"]).to_numpy(), number.reindex(known["id_hi"]).to_numpy()
    both = ~(np.isnan(a) | np.isnan(b))
    matrix = np.zeros((len(own), len(own)), np.int32)
    a, b = a[both].astype(int), b[both].astype(int)
    matrix[a, b] = matrix[b, a] = np.rint(known["delta_g"].to_numpy()[both] * UNIT)
    return own["primer_id"].to_numpy(), [part.index.to_numpy() for _, part in own.groupby("gene_idx")], matrix


def anneal_chains(
    candidates: DataFrame, scores: DataFrame | None = None, fixed: int = 0, chains: int = 200, cycles: int = 2000, temperature: float = 600.0, beta: float = 0.997, top: int = 10, seed: int = 0,
    energies=dimer_energies, pool: str | None = None,
) -> DataFrame:
    """The best sets of independent chains: (chain, rank_score, avg_score, min_score, primers), top of them; of each pool, which leads the columns, where candidates are pooled.

    A pool is a panel: some hundred pairs for each of its genes, whose scores a task holds
    (at most POOL pairs, else a ValueError).  Pools are any number; small ones are dealt
    several to a call, which takes their chains in step.  Without scores, those of all pairs
    of a pool are worked out first, each distinct two oligos once.
    """
    pool_ = F.col(f"`{pool}`") if pool else F.lit(0)
    if scores is None:
        scores = stored(dimer_scores(candidates, energies, pool), "dimers")
    blocks, bundles = max(1, -(-chains // CHAINS)), max(1, -(-candidates.count() // DEALT)) if pool else 1
    block, bundle = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64(pool_), F.lit(bundles)).alias("bundle")
    left = candidates.select(pool_.alias("pool"), bundle, block, "gene_idx", "primer_id")
    right = scores.select(pool_.alias("pool"), bundle, block, "id_lo", "id_hi", "delta_g")
    kind = left.schema["pool"].dataType.simpleString()

    def run(key: tuple, own: pd.DataFrame, known: pd.DataFrame) -> Iterator[pd.DataFrame]:
        mine = list(range(key[1] * CHAINS, min(chains, (key[1] + 1) * CHAINS)))
        if not len(own) or not mine:
            yield pd.DataFrame(columns=["pool", "chain", "rank_score", "avg_score", "min_score", "primers"])
            return
        held, said = [], known.groupby("pool").indices

        def done() -> Iterator[pd.DataFrame]:
            found = anneal_pools([(genes, matrix) for _, _, genes, matrix in held], fixed, cycles, temperature, beta, seed, mine)
            for (name, ids, _, _), (rank, avg, low, best) in zip(held, found):
                yield pd.DataFrame({"pool": [name] * len(mine), "chain": mine, "rank_score": rank, "avg_score": avg, "min_score": low, "primers": ids[best].tolist()})
            held.clear()

        for name, part in own.groupby("pool", dropna=False):
            if len(part) > POOL:
                raise ValueError(f"a pool has {len(part)} candidates, more than {POOL}")
            ids, genes, matrix = _scored(part, known.iloc[said.get(name, [])])
            if held and (len(held) == IN_STEP or len(held[0][2]) != len(genes) or sum(m.size for *_, m in held) + matrix.size > SCORES):
                yield from done()
            held.append((name, ids, genes, matrix))
        yield from done()

    parts = _parts(candidates.sparkSession)
    left, right = (rows.repartition(parts, "bundle", "block") for rows in (left, right))
    done = left.groupBy("bundle", "block").cogroup(right.groupBy("bundle", "block")).applyInPandas(lambda key, a, b: pd.concat(list(run(key, a, b)), ignore_index=True), f"pool {kind}, chain int, rank_score double, avg_score double, min_score double, primers array<string>")
    place = F.row_number().over(W.partitionBy("pool").orderBy(F.desc("rank_score"), "chain"))
    out = done.withColumn("place", place).where(F.col("place") <= top).drop("place")
    return out.withColumnRenamed("pool", pool) if pool else out.drop("pool").orderBy(F.desc("rank_score"), "chain")
