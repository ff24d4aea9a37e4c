"""Energies of two oligos bound to one another: a dynamic programme over all duplexes that hold a 3' end, many pairs at a time."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np

# Fixed values (public: unified nearest-neighbour parameters for DNA, in 1 M NaCl).
#: Enthalpy in kcal/mol and entropy in cal/(mol K) of a stack, by the two bases 5' to 3' of either strand.
STACKS = {
    "AA": (-7.6, -21.3), "AT": (-7.2, -20.4), "TA": (-7.2, -21.3), "CA": (-8.5, -22.7), "GT": (-8.4, -22.4),
    "CT": (-7.8, -21.0), "GA": (-8.2, -22.2), "CG": (-10.6, -27.2), "GC": (-9.8, -24.4), "GG": (-8.0, -19.9),
}
#: Of a duplex's begin, and of each end that is a pair of A and T.
BEGIN, WEAK_END = (0.2, -5.7), (2.2, 6.9)
#: Free energies in kcal/mol at 37 C by unpaired bases: of bulges, from 1 on, and of internal loops, from 3 on; a loop's for each base that its sides differ by.
BULGES = (4.0, 2.9, 3.1, 3.2, 3.3, 3.5, 3.7, 3.9, 4.1, 4.3)
INTERNAL = (3.2, 3.6, 4.0, 4.4, 4.6, 4.8, 4.9, 4.9)
UNEVEN = 0.3
#: Entropy of salt for each stack, in cal/(mol K), beside the logarithm of the concentration.
SALT_ENTROPY = 0.368
KELVIN, BODY = 273.15, 310.15

# Own choices.
#: Free energy of one mismatched pair, in kcal/mol at 37 C: a mean, as it depends on its neighbours. Unpaired bases between two pairs, at most.
MISMATCH, LOOP = 0.8, 10
#: The conditions that pools are scored under: degrees C, and mmol/l of monovalent ions, of divalent ones and of nucleotides.
CELSIUS, MONOVALENT, DIVALENT, NUCLEOTIDES = 25.0, 200.0, 3.0, 0.2
#: Pairs of oligos that go through the programme together.
TOGETHER = 2048
NONE = 1 << 28


class Model:
    """Free energies under given conditions, in thousandths of kcal/mol, whole numbers."""

    def __init__(self, celsius: float = CELSIUS, monovalent: float = MONOVALENT, divalent: float = DIVALENT, nucleotides: float = NUCLEOTIDES):
        kelvin = KELVIN + celsius
        salt = (monovalent + 120 * math.sqrt(max(0.0, divalent - nucleotides))) / 1000
        free = lambda h, s: round(1000 * h - kelvin * s)
        loop = lambda g: round(1000 * g * kelvin / BODY)  # noqa: E731  loops are of entropy alone
        other = str.maketrans("ACGT", "TGCA")
        self.stack = np.zeros((5, 5), np.int32)
        for two, (h, s) in STACKS.items():
            for a, b in (two, two.translate(other)[::-1]):
                self.stack["ACGT".index(a), "ACGT".index(b)] = free(h, s + SALT_ENTROPY * math.log(salt))
        self.begin, self.weak = free(*BEGIN), free(*WEAK_END)
        self.bulge = (0, *map(loop, BULGES))
        self.internal = (0, 0, loop(MISMATCH), *map(loop, INTERNAL))
        self.uneven = loop(UNEVEN)


_CODE = np.full(256, 4, np.uint8)
for _k, _c in enumerate("ACGT"):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _k


def _frame(model: Model, n: int) -> tuple[type, int, int]:
    """The type that energies of n bases fit into, what stands there for zero, and for no pair: what any loop adds to it is less than a new beginning."""
    deepest, loops = -int(model.stack.min(initial=0)), max(*model.bulge, *model.internal) + model.uneven * LOOP + 2 * abs(model.weak)
    none = model.begin + 2 * abs(model.weak) + deepest + 1
    if none + loops + (n - 1) * deepest < (1 << 16) - 16 and model.begin >= 0:
        return np.int16, (1 << 15) - 8 - none - loops, (1 << 15) - 8 - loops
    return np.int32, 0, NONE


def anchored(x: np.ndarray, y: np.ndarray, model: Model, relaxed: bool = False) -> np.ndarray:
    """For each row of two matrices of bases the lowest energy of a duplex that pairs x's last base; at most 0.

    x's base i pairs with one of y, read backwards; a duplex's next pair lies further on in
    both, behind a stack, a bulge or an internal loop.  Rows of energies for x's bases, one
    after the other, each for all pairs of oligos and all bases of y.  Internal loops of a
    size grow from those that have a base less on both sides.

    relaxed: every longer bulge and every longer loop costs what the cheapest one does, so
    that the result is a bound from below, at a third of the work.
    """
    rows, n, m = len(x), x.shape[1], y.shape[1]
    if not n or not m:
        return np.zeros(rows, np.int32)
    kind, zero, none = _frame(model, n)
    # bases lead, so that a step goes over all pairs of oligos in one stretch of memory
    x, back = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T[::-1])
    partner = np.uint8(3) - x  # of codes of bases that pair; 255 for other letters
    weak = np.where((x == 0) | (x == 3), model.weak, 0).astype(kind)
    floor = kind(np.iinfo(kind).min)
    height = np.int64(none - int(floor)).astype(kind)  # modulo the type's size, as the sum with floor is
    stack, begin = model.stack.astype(kind), kind(model.begin + zero)
    energy = np.full((n, m, rows), none, kind)
    some, best = np.empty((m, rows), kind), np.empty((m, rows), kind)

    def take(source: np.ndarray, shift: int, add) -> None:
        """best's j from source's j - shift."""
        if shift < m:
            np.minimum(best[shift:], np.add(source[: m - shift], add, out=some[: m - shift]), out=best[shift:])

    step = _relaxed(energy, model, kind, none, take) if relaxed else _loops(energy, weak, model, kind, none, take)
    for i in range(n):
        best[:] = begin + weak[i]
        if i:
            own = stack[x[i - 1], x[i]]
            take(energy[i - 1], 1, own)
            # a single base that bulges out leaves the stack
            take(energy[i - 1], 2, own + kind(model.bulge[1]))
            if i > 1:
                take(energy[i - 2], 1, stack[x[i - 2], x[i]] + kind(model.bulge[1]))
                take(energy[i - 2], 2, kind(model.internal[2]))
            step(i)
        # what doesn't pair is lifted to none
        wall = (back != partner[i]).astype(kind)
        wall *= height
        wall += floor
        np.maximum(best, wall, out=energy[i])
    return np.minimum((energy[n - 1] + weak[n - 1]).min(0).astype(np.int32) - zero, 0)


def _loops(energy: np.ndarray, weak: np.ndarray, model: Model, kind: type, none: int, take):
    """A step of anchored(): bulges of two bases and more, and internal loops of three and more."""
    n, m, rows = energy.shape
    ended = np.full((n, m, rows), none, kind)
    # by size: the cheapest internal loop that ends before j, without what its size costs
    grown, spare = (np.full((LOOP + 1, m, rows), none, kind) for _ in range(2))
    other, uneven = np.empty((m, rows), kind), kind(model.uneven)

    def step(i: int) -> None:
        nonlocal grown, spare
        np.add(energy[i - 1], weak[i - 1], out=ended[i - 1])
        for size in range(2, LOOP + 1):
            # bulges on either side; an end's pair of A and T costs on both sides of it
            add = weak[i] + kind(model.bulge[size])
            take(ended[i - 1], 1 + size, add)
            if i - 1 - size >= 0:
                take(ended[i - 1 - size], 1, add)
        for size in range(2, LOOP + 1):
            now = spare[size]
            now[:] = none
            if size > 3 and m > 1:
                np.copyto(now[1:], grown[size - 2][:-1])
            lean = kind(uneven * (size - 2))
            for before, shift in ((i - 2, size), (i - size, 2))[: 1 if size == 2 else 2]:
                if before >= 0 and shift < m:
                    np.minimum(now[shift:], np.add(energy[before][: m - shift], lean, out=other[: m - shift]), out=now[shift:])
            if size > 2:
                take(now, 0, kind(model.internal[size]))
        # size 4 grows from size 2, whose loops take() has had before
        grown, spare = spare, grown

    return step


def _relaxed(energy: np.ndarray, model: Model, kind: type, none: int, take):
    """A step of anchored() in which longer bulges, and longer internal loops, cost what the cheapest one does."""
    n, m, rows = energy.shape
    bulge = kind(min(model.bulge[2:]) + 2 * min(0, model.weak))
    loop = kind(min(model.internal[a + b] + model.uneven * abs(a - b) for a in range(1, LOOP) for b in range(1, LOOP + 1 - a) if a + b > 2))
    reach = LOOP - 1  # places that either side's loop may begin at
    some, nothing = np.empty((m, rows), kind), np.full((m, rows), none, kind)
    left = nothing

    def step(i: int) -> None:
        nonlocal left
        take(left, 1, bulge)  # rows i - 11 to i - 3
        left = reduce(np.minimum, energy[max(0, i - LOOP) : i - 1], nothing)
        # a bulge in the other oligo begins one place further back than a loop does
        near = left + loop
        np.minimum(near[1:], np.add(energy[i - 1][:-1], bulge, out=some[1:]), out=near[1:])
        wide, width = near, 1
        while 2 * width <= reach:
            twice = wide.copy()
            np.minimum(twice[width:], wide[:-width], out=twice[width:]) if width < m else None
            wide, width = twice, 2 * width
        if width < reach and reach - width < m:
            last = wide.copy()
            np.minimum(last[reach - width :], wide[: width - reach], out=last[reach - width :])
            wide = last
        take(wide, 2, kind(0))

    return step


def energies(xs: list[str], ys: list[str], model: Model | None = None, below: np.ndarray | None = None) -> np.ndarray:
    """In thousandths of kcal/mol, for each two oligos: the lowest energy of a duplex that holds the 3' end of either; 0 where none binds.

    below: bounds that only lower energies are asked for; where an energy isn't, the result
    is any that isn't below the bound either.
    """
    model = model or Model()
    out = np.zeros(len(xs), np.int64)
    sizes: dict[tuple[int, int], list[int]] = {}
    for k, (a, b) in enumerate(zip(xs, ys)):
        sizes.setdefault((len(a), len(b)), []).append(k)
    code = lambda texts, size: _CODE[np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8)].reshape(-1, size)
    parts = lambda rows, size: (rows[low : low + size] for low in range(0, len(rows), size))
    for (n, m), of in sizes.items():
        if not n or not m:
            continue
        at = np.array(of)
        x, y = code([xs[k] for k in of], n), code([ys[k] for k in of], m)
        for a, b in ((x, y), (y, x)):
            asked = np.arange(len(of))
            if below is not None:
                asked = np.concatenate([some[anchored(a[some], b[some], model, True) < np.minimum(below[at[some]], out[at[some]])] for some in parts(asked, 2 * TOGETHER)])
            for some in parts(asked, TOGETHER):
                out[at[some]] = np.minimum(out[at[some]], anchored(a[some], b[some], model))
    return out
