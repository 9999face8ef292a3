"""Paired opposite-strand pile-ups (analysis ``digenome``): candidate pairs, one-to-one assignment, scores."""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmark.functions.statistics import contribution, pair_score, ratio, weighted_mean
from strandmark.operators import scans
from strandmark.operators import sites as S
from strandmark.operators.intervals import covered
from strandmark.schema import METRICS, Params
from strandmark.session import by_rows, written

PAIR = ["contig", "forward_position", "reverse_position"]


def least_count(params: Params) -> int:
    """Of a pile-up that can be a side of a pair: that of the laxer strand, so pairs with too few on one side are there too."""
    return min(params.digenome_forward_cutoff, params.digenome_reverse_cutoff) + 1


def edges(reads: DataFrame, params: Params, mask: DataFrame | None = None, within: Column | None = None, piles: DataFrame | None = None) -> DataFrame:
    """PAIR of the pile-ups around the expected distance; only of pile-ups that are ``within`` (a condition on contig and pos), if given. ``piles``: written pile-ups,
    if there are such already."""
    least = least_count(params)
    if piles is None:
        found = S.pileups(reads, least, params.digenome_min_mapq, mask)
        if within is not None:
            found = found.where(within)
        found = by_rows(written(found, "piles"))
    else:
        found = piles.where(F.col("count") >= least)
    w = params.digenome_pair_window
    forward = found.where("strand = '+'").select("contig", F.col("pos").alias("forward_position"))
    reverse = found.where("strand = '-'").select("contig", F.col("pos").alias("reverse_position"))
    expected = F.col("forward_position") - params.digenome_overhang
    pairs = forward.withColumn("reverse_position", F.explode(F.sequence(expected - w, expected + w))).join(reverse, ["contig", "reverse_position"])
    return by_rows(written(pairs.select(*PAIR), "edges"))


def sides(pairs: DataFrame, forward: str = "forward_position", reverse: str = "reverse_position") -> DataFrame:
    """(contig, pos, strand) of both endpoints of each pair."""
    one = lambda strand, name: F.struct(F.col(name).alias("pos"), F.lit(strand).alias("strand"))
    return pairs.select("contig", F.explode(F.array(one("+", forward), one("-", reverse))).alias("s")).select("contig", "s.*")


def candidates(reads: DataFrame, params: Params, mask: DataFrame | None = None, metrics: bool = True, pairs: DataFrame | None = None, measured: DataFrame | None = None) -> DataFrame:
    """Pairs of a forward and a reverse pile-up around the expected distance, with score and caller reasons; ``pairs``: those to look at,
    if they are known already; ``measured``: the written metrics at their sides, so too."""
    pairs = edges(reads, params, mask) if pairs is None else pairs
    if measured is None:
        wanted = sides(pairs)
        measured = S.metrics(wanted, reads, params.artifact_window, params.digenome_min_mapq) if metrics else S.depths(wanted, reads, params.digenome_min_mapq)
        measured = by_rows(written(measured, "measured"))  # both strands' sides are of it
    names = METRICS if metrics else ["endpoint_count", "strand_depth", "endpoint_fraction"]
    side = lambda strand, name, out: measured.where(F.col("strand") == strand).select("contig", F.col("pos").alias(name), F.struct(*names).alias(out))
    pairs = pairs.join(side("+", "forward_position", "f"), ["contig", "forward_position"]).join(side("-", "reverse_position", "r"), ["contig", "reverse_position"])
    score = pair_score(F.col("f.endpoint_count"), F.col("f.endpoint_fraction"), F.col("r.endpoint_count"), F.col("r.endpoint_fraction"))
    return pairs.withColumn("pair_score", score).withColumn("caller_reasons", caller_reasons(params)).select(*PAIR, "f", "r", "pair_score", "caller_reasons")


def caller_reasons(params: Params) -> Column:
    """Values at a cutoff fail."""
    tests = [
        (F.col("f.endpoint_count") <= params.digenome_forward_cutoff, "LOW_FORWARD_COUNT"),
        (F.col("r.endpoint_count") <= params.digenome_reverse_cutoff, "LOW_REVERSE_COUNT"),
        (F.col("f.strand_depth") <= params.digenome_depth_cutoff, "LOW_FORWARD_DEPTH"),
        (F.col("r.strand_depth") <= params.digenome_depth_cutoff, "LOW_REVERSE_DEPTH"),
        (F.col("f.endpoint_fraction") <= params.digenome_fraction_cutoff, "LOW_FORWARD_FRACTION"),
        (F.col("r.endpoint_fraction") <= params.digenome_fraction_cutoff, "LOW_REVERSE_FRACTION"),
        (F.col("pair_score") <= params.digenome_pair_score_cutoff, "LOW_DIGENOME_PAIR_SCORE"),
    ]
    return F.array_compact(F.array(*[F.when(t, F.lit(name)) for t, name in tests]))


def components(pairs: DataFrame, overhang: int) -> DataFrame:
    """pairs with ``component``: pairs that share an endpoint, directly or over others, have one number in a contig.

    Shifted by the overhang, a component is an island of overlapping closed spans, so a running maximum finds it (scans.islands: over ranges, no task
    holds a contig).
    """
    low = F.least(F.col("forward_position") - overhang, F.col("reverse_position"))
    high = F.greatest(F.col("forward_position") - overhang, F.col("reverse_position"))
    rows = scans.ranged(pairs.withColumns({"_low": low, "_high": high}), ["contig"], ["_low", "_high", "forward_position", "reverse_position"], "pair-ranges")
    found = scans.islands(rows, ["contig"], ["_low", "_high", "forward_position", "reverse_position"], "_low", "_high", "component", touching=True)
    return found.drop("_low", "_high", scans.PART)


#: Decimals to which score sums are compared: equal ratios of counts can differ in the last bits of a double.
DIGITS = 9


def ratio_of(score: float) -> tuple[int, int]:
    """The ratio of counts that a score is as nearly as a double can be, if there is a plain one; else the double's own."""
    near = Fraction(score).limit_denominator(10**6)
    return (near if abs(near - Fraction(score)) <= Fraction(4 * math.ulp(score)) else Fraction(score)).as_integer_ratio()


def best_assignment(edges: list[tuple[int, int, bool, float]]) -> list[int]:
    """Indices of the one-to-one choice of (forward, reverse, passes, score), given in coordinate order.

    Lexicographically best: passing pairs, pairs, score sum (of ``ratio_of``, exact), smallest sum of coordinate ranks, then the choice
    that is first in coordinate order. Each edge's worth is one integer, its fields too far apart to carry; the
    assignment problem over these is solved with potentials, a row at a time.
    """
    ratios = [ratio_of(float(e[3])) for e in edges]
    unit = math.lcm(*(d for _, d in ratios))
    n = len(edges)
    scores = [a * (unit // d) for a, d in ratios]
    low = 1 << n
    ranks = low * (n * n + 1)
    worth_of_score = ranks * 1
    whole = (2 * sum(map(abs, scores)) + 2) * worth_of_score
    pair, passing = whole * 1, whole * (n + 1)
    worth = {}
    for k, ((f, r, good, _), s) in enumerate(zip(edges, scores)):
        worth[f, r] = (passing * int(good) + pair + s * worth_of_score - k * low + (1 << n - 1 - k), k)
    rows, columns = sorted({e[0] for e in edges}), sorted({e[1] for e in edges})
    # each row may also stay alone: a column of its own, worth nothing
    width = len(columns) + len(rows)
    impossible = sum(w for w, _ in worth.values()) + passing

    def cost(i: int, j: int) -> int:
        if j < len(columns):
            return -worth[rows[i], columns[j]][0] if (rows[i], columns[j]) in worth else impossible
        return 0 if j - len(columns) == i else impossible

    u, v, owner = [0] * (len(rows) + 1), [0] * (width + 1), [0] * (width + 1)
    for i in range(1, len(rows) + 1):
        owner[0], at = i, 0
        least: list[int | None] = [None] * (width + 1)
        came, seen = [0] * (width + 1), [False] * (width + 1)
        while owner[at]:
            seen[at], row, step, to = True, owner[at], None, 0
            for j in range(1, width + 1):
                if not seen[j]:
                    c = cost(row - 1, j - 1) - u[row] - v[j]
                    if least[j] is None or c < least[j]:
                        least[j], came[j] = c, at
                    if step is None or least[j] < step:
                        step, to = least[j], j
            for j in range(width + 1):
                if seen[j]:
                    u[owner[j]] += step
                    v[j] -= step
                elif least[j] is not None:
                    least[j] -= step
            at = to
        while at:
            owner[at] = owner[came[at]]
            at = came[at]
    chosen = [worth[rows[owner[j + 1] - 1], columns[j]][1] for j in range(len(columns)) if owner[j + 1] and (rows[owner[j + 1] - 1], columns[j]) in worth]
    return sorted(chosen)


#: Reverse endpoints that are open at once, up to which an assignment is walked along the contig.
MOST_OPEN = 12


def most_open(edges: list[tuple[int, int, bool, float]]) -> int:
    """How many reverse endpoints at most have a forward one both before (or at) and at (or after) some step."""
    first, last = {}, {}
    order = {f: k for k, f in enumerate(sorted({e[0] for e in edges}))}
    for f, r, *_ in edges:
        first.setdefault(r, order[f])
        last[r] = order[f]
    change = [0] * (len(order) + 1)
    for r in first:
        change[first[r]] += 1
        change[last[r] + 1] -= 1
    return max(accumulate(change))


def walked_assignment(edges: list[tuple[int, int, bool, float]]) -> list[int]:
    """What best_assignment chooses (score sums compared to DIGITS decimals), by one walk over the forward endpoints: a state is which reverse endpoints that a later
    forward one can still have are taken, and only the best way into each state goes on. Linear in the edges for a given
    ``most_open``, so a long crowded region costs no more than its parts."""
    ratios = [float(e[3]).as_integer_ratio() for e in edges]
    unit = max(d for _, d in ratios)
    by_forward: dict[int, list[tuple[int, int]]] = {}
    for k, e in enumerate(edges):
        by_forward.setdefault(e[0], []).append((e[1], k))
    order = sorted(by_forward)
    least_later, smallest = {}, None
    for f in reversed(order):
        least_later[f] = smallest
        smallest = min([r for r, _ in by_forward[f]] + ([smallest] if smallest is not None else []))
    # worths as they are compared: the exact sum of scores, rounded
    compared = lambda worth: (worth[0], worth[1], (2 * worth[2] * 10**DIGITS + unit) // (2 * unit), worth[3])
    # taken reverse endpoints -> (worth, rank of the choices so far (smaller: earlier in order), chosen edges as a chain)
    states: dict[frozenset, tuple] = {frozenset(): ((0, 0, 0, 0), 0, None)}
    for f in order:
        options = [*enumerate(sorted(by_forward[f])), (len(by_forward[f]), None)]
        found: dict[frozenset, tuple] = {}
        for taken, (worth, rank, chain) in states.items():
            for choice, option in options:
                if option is None:
                    now, value, link = taken, worth, chain
                elif option[0] in taken:
                    continue
                else:
                    k = option[1]
                    a, d = ratios[k]
                    now, link = taken | {option[0]}, (k, chain)
                    value = (worth[0] + int(edges[k][2]), worth[1] + 1, worth[2] + a * (unit // d), worth[3] - k)
                now = frozenset(r for r in now if least_later[f] is not None and r >= least_later[f])
                known = found.get(now)
                if known is None or compared(value) > compared(known[0]) or compared(value) == compared(known[0]) and (rank, choice) < known[1]:
                    found[now] = (value, (rank, choice), link)
        ranks = {h: n for n, h in enumerate(sorted({x[1] for x in found.values()}))}
        states = {s: (value, ranks[h], link) for s, (value, h, link) in found.items()}
    ((_, _, chain),) = states.values()
    chosen = []
    while chain:
        chosen.append(chain[0])
        chain = chain[1]
    return sorted(chosen)


def assignment(edges: list[tuple[int, int, bool, float]]) -> list[int]:
    return walked_assignment(edges) if most_open(edges) <= MOST_OPEN else best_assignment(edges)


def select_pairs(pairs: DataFrame, overhang: int) -> DataFrame:
    """One-to-one pairs. Single pairs and stars are decided by a window; only the rest goes to Python, by component."""
    slim = components(pairs.select(*PAIR, "pair_score", (F.size("caller_reasons") == 0).alias("good")), overhang)
    w = Window.partitionBy("contig", "component")
    order = w.orderBy(F.col("good").desc(), F.round("pair_score", DIGITS).desc(), "forward_position", "reverse_position")
    first_last = lambda c: F.min(c).over(w) == F.max(c).over(w)
    slim = slim.withColumns({"_star": first_last("forward_position") | first_last("reverse_position"), "_k": F.row_number().over(order)})
    easy = slim.where("_star AND _k = 1").select(*PAIR)

    @F.pandas_udf("array<int>")
    def choose(forward: pd.Series, reverse: pd.Series, good: pd.Series, score: pd.Series) -> pd.Series:
        return pd.Series([assignment([(int(f), int(r), bool(g), float(s)) for f, r, g, s in zip(*edges)]) for edges in zip(forward, reverse, good, score)])

    fields = ["forward_position", "reverse_position", "good", "pair_score"]
    hard = slim.where("NOT _star").groupBy("contig", "component").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("e"))
    hard = hard.withColumn("_chosen", choose(*[F.col(f"e.{f}") for f in fields])).select("contig", "e", F.explode("_chosen").alias("_k"))
    hard = hard.select("contig", *[F.element_at("e", F.col("_k") + 1)[f].alias(f) for f in PAIR[1:]])
    return pairs.join(easy.union(hard), PAIR, "left_semi")


def combined(f: str = "f", r: str = "r") -> dict[str, Column]:
    """Both strands' metrics as one; windows that overlap count twice, the indel is the more frequent one's."""
    a, b = (lambda c: F.col(f"{f}.{c}")), (lambda c: F.col(f"{r}.{c}"))
    total = lambda c: a(c) + b(c)
    forward = (a("indel_fraction") > b("indel_fraction")) | ((a("indel_fraction") == b("indel_fraction")) & (a("indel_read_count") >= b("indel_read_count")))
    out = {c: total(c) for c in METRICS if c.endswith("_count") or c == "strand_depth"}
    out |= {c: F.when(forward, a(c)).otherwise(b(c)) for c in ("indel_position", "indel_type", "indel_length")}
    for kind, n in (("support", "support_read_count"), ("local", "local_read_count")):
        out[f"{kind}_mean_mapq"] = weighted_mean(a(f"{kind}_mean_mapq"), a(n), b(f"{kind}_mean_mapq"), b(n))
        out[f"{kind}_mean_nm"] = weighted_mean(a(f"{kind}_mean_nm"), a(f"{kind}_nm_count"), b(f"{kind}_mean_nm"), b(f"{kind}_nm_count"))
    out["endpoint_fraction"] = ratio(total("endpoint_count"), total("strand_depth"))
    out["softclip_fraction"] = ratio(total("softclipped_count"), total("endpoint_count"))
    out["indel_fraction"] = ratio(total("indel_read_count"), total("local_read_count"))
    return {c: out[c] for c in METRICS}


def grid_places(pairs: DataFrame, overhang: int) -> DataFrame:
    """(contig, pos): ends of the places at which evidence for pairs(contig, forward_position, reverse_position) is asked for."""
    f = F.col("forward_position")
    ends = [f, F.col("reverse_position"), f - 2, f + 2, f + overhang - 3, f + overhang + 1]
    return pairs.select("contig", F.explode(F.array(*[F.greatest(e, F.lit(0)) for e in ends])).alias("pos"))


def grid_offsets(overhang: int) -> list[int]:
    """Of the score's places from the forward position."""
    return sorted({anchor + k for anchor in (0, overhang - 1) for k in range(-2, 3)})


def grid_reach(overhang: int) -> int:
    """That reads must be cut with (sites.cut) to score them."""
    return max(map(abs, grid_offsets(overhang)))


def single_precision_score(positions: DataFrame, reads: DataFrame, contigs: DataFrame, overhang: int, min_mapq: int, mask: DataFrame | None = None, name: str = "rgen_digenome_score") -> DataFrame:
    """(contig, forward_position, name): the five-position score around each forward position.

    Places outside the contig or in the mask add nothing. The forward anchor is the position, the reverse one
    position + overhang - 1; sums are rounded to FLOAT in the order of offsets.
    """
    offsets = grid_offsets(overhang)
    own = positions.select("contig", F.col("forward_position").alias("pos")).distinct()
    hidden = own.withColumn("_hidden", F.lit(0).cast("long")) if mask is None else own.join(covered(own, mask, offsets, "_hidden"), ["contig", "pos"], "left")
    lengths = contigs.groupBy("contig").agg(F.max("length").alias("_length"))
    wide = hidden.join(F.broadcast(lengths), "contig", "left").join(S.around(own, reads, offsets, min_mapq), ["contig", "pos"], "left")
    there = [f"pos + ({o}) >= 0 AND pos + ({o}) < _length AND (coalesce(_hidden, 0L) & {1 << n}L) = 0" for n, o in enumerate(offsets)]
    wide = wide.select("contig", "pos", *[F.expr(f"CASE WHEN {t} THEN coalesce({c}{n}, 0L) ELSE 0L END").alias(f"{c}{n}") for n, t in enumerate(there) for c in "frd"])
    total = "CAST(0 AS FLOAT)"
    of = lambda count, anchor, k: f"{count}{offsets.index(anchor + k)}"
    back = overhang - 1
    for k in range(-2, 3):
        forward = contribution(of("f", 0, 0), of("d", 0, 0), of("r", back, k), of("d", back, k))
        reverse = contribution(of("r", back, 0), of("d", back, 0), of("f", 0, k), of("d", 0, k))
        total = f"CAST(CAST({reverse} + {forward} AS FLOAT) + {total} AS FLOAT)"
    return wide.select("contig", F.col("pos").alias("forward_position"), F.expr(total).cast("double").alias(name))


def reach(params: Params) -> int:
    """That a call's reads are cut with."""
    return max(params.artifact_window, grid_reach(params.digenome_overhang))


def calls(reads: DataFrame, contigs: DataFrame, params: Params, mask: DataFrame | None = None, pairs: DataFrame | None = None, own: Column | None = None, measured: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidate pairs, call rows before controls and filters). With ``pairs`` (PAIR, whole components) these are assigned; with ``own``
    (a condition on contig and forward_position) only those for which it holds go on. ``measured``, with written ``pairs`` and cut reads: as for ``candidates``."""
    if measured is None:
        known = edges(reads, params, mask) if pairs is None else by_rows(written(pairs, "edges"))
        reads = S.cut(reads, grid_places(known, params.digenome_overhang), reach(params))
    else:
        known = pairs
    pairs = by_rows(written(candidates(reads, params, mask, pairs=known, measured=measured), "pairs"))
    chosen = select_pairs(pairs, params.digenome_overhang)
    if own is not None:
        chosen, pairs = chosen.where(own), pairs.where(own)
    chosen = by_rows(written(chosen, "chosen"))
    score = by_rows(written(single_precision_score(chosen, reads, contigs, params.digenome_overhang, params.digenome_min_mapq, mask), "scores"))
    own = chosen.join(score, ["contig", "forward_position"])
    both = {f"{name}_{out}": F.col(f"{s}.{c}") for s, name in (("f", "forward"), ("r", "reverse")) for out, c in (("endpoint_count", "endpoint_count"), ("depth", "strand_depth"), ("fraction", "endpoint_fraction"))}
    rows = own.select(
        "contig", F.col("forward_position").alias("pos"), F.lit("both").alias("strand"), *[c.alias(n) for n, c in combined().items()],
        F.col("forward_position").alias("forward_position_0based"), F.col("reverse_position").alias("reverse_position_0based"), F.col("reverse_position").alias("opposite_position_0based"),
        F.col("r.endpoint_count").alias("opposite_count"), F.col("r.strand_depth").alias("opposite_depth"), F.col("r.endpoint_fraction").alias("opposite_fraction"),
        *[c.alias(n) for n, c in both.items()], F.col("pair_score").alias("digenome_pair_score"), "rgen_digenome_score", F.lit("DSB").alias("signal_classification"), "caller_reasons",
    )
    return pairs, rows
