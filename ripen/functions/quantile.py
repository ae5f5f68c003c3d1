"""Exact order statistics and quantiles without one task holding a column.

Spark's exact ``percentile``/``median`` aggregates keep a value->count map
and merge every partition's map into a single buffer, so at scale one task
holds all distinct values of a column.  Here the exact answer is found by
selection instead:

1. one pass: ``count`` and ``percentile_approx`` a little below and above
   each wanted rank (a bounded sketch);
2. one pass: exact counts below / at / inside / at the top of each bracket;
   values sitting on a bracket edge (ties, hot values) resolve here;
3. only the few values strictly inside a bracket are sorted, and the one at the
   rank reaches the driver -- in the pass of step 2 itself whenever the sketch's error
   bound guarantees that they fit (``MAX_PICK`` values of all targets together, hundreds
   of millions of rows for a few columns), else in one more pass; wider brackets are
   refined by repeating steps 1-2 inside the bracket.

Many ranks of one column (more than ``MANY``) are not counted bracket by bracket:
their edges cut the column into intervals, which are counted in one grouping, and one more
groups the values of the intervals that hold a rank and picks it.  Intervals of more than ``MAX_GROUP``
values are cut again by a sketch of their own, all of them in one grouping.

Every pass is a plain scan + partial/final aggregate, batched over all
columns and ranks.  Quantiles interpolate linearly between order statistics
(pandas / DuckDB ``quantile_cont`` semantics).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .scan import GRID, Aggregate, Codes, Cuts, Fit, Members, run

ACCURACY = 10000
MARGIN = 4.0          # bracket half-width in units of the sketch's rank error
MAX_COLLECT = 20000   # values of a target sorted in the final pass, whatever the number of targets
MAX_PICK = 1 << 21    # values of all targets together that one aggregate sorts
MAX_GROUP = 1 << 18   # values of an interval that one group sorts
MANY = 8              # ranks of one column from which on intervals are counted
EAGER_COLLECT = True  # pick inside-bracket values in the verify pass when bounded


def _cond(c: Column, cond: Column | None) -> Column:
    return c if cond is None else F.when(cond, c)


def order_statistics(df: DataFrame, targets: list[tuple], accuracy: int = ACCURACY,
                     max_collect: int = MAX_COLLECT, brackets: list | None = None) -> list[float | None]:
    """``order_steps`` over a table of its own."""
    return run(df, order_steps(targets, accuracy, max_collect, brackets))


def order_steps(targets: list[tuple], accuracy: int = ACCURACY, max_collect: int = MAX_COLLECT, brackets: list | None = None) -> Fit:
    """Exact r-th smallest non-null value for each target.

    ``targets`` holds tuples ``(value_expr, cond_expr_or_None, r, n, group)``:
    ``n`` non-null values satisfy ``cond``, ``r`` is a 0-based rank (< n) and
    targets with the same ``group`` read the same values (they share the
    final collect).  ``brackets`` (optional, per target) are first-round
    approximate (low, high) values computed by the caller's own pass.
    Returns the values in target order.
    """
    k = len(targets)
    vals: list = [None] * k
    # per-target region (None = unbounded, ("open", x) = exclusive) and rows left of it
    lo: list = [None] * k
    hi: list = [None] * k
    below = [0] * k
    size = [t[3] for t in targets]
    pending = [i for i in range(k) if targets[i][3] > 0]
    groups: dict = {}
    for i in pending:
        if targets[i][1] is None and targets[i][3] > max_collect:
            groups.setdefault(targets[i][4], []).append(i)
    many = {g: rows for g, rows in groups.items() if len(rows) > MANY} if brackets is not None else {}
    if many:
        found, wide = yield from _interval_steps(targets, brackets, many, max_collect)
        for i, x in found.items():
            vals[i] = x
        for i, (b, n, low, high) in wide.items():
            below[i], size[i], lo[i], hi[i] = b, n, low, high
        pending = [i for i in pending if i not in found]
        brackets = None if wide else brackets      # brackets of narrowed regions are made anew
    for _round in range(8):
        if not pending:
            break
        # small regions: collect the region once per (group, region) and index it
        room = max(max_collect, MAX_PICK // len(pending))
        small = [i for i in pending if size[i] <= (room if _round else max_collect)]
        if small:
            shared: dict = {}
            for i in small:
                shared.setdefault((targets[i][4], repr(lo[i]), repr(hi[i])), []).append(i)
            exprs = {}
            for members in shared.values():
                i = members[0]
                v, cond = targets[i][0].cast("double"), targets[i][1]
                m = _region(v, lo[i], hi[i], cond)
                inside = F.sort_array(F.collect_list(F.when(m, v)))
                exprs |= {f"s{i}": F.get(inside, F.lit(targets[i][2] - below[i])) for i in members}
            (row,) = yield [Aggregate(exprs)]
            for i in small:
                vals[i] = row[f"s{i}"]
            pending = [i for i in pending if i not in set(small)]
            if not pending:
                break
        # step 1: approximate values just below and above the rank, inside the region
        if _round == 0 and brackets is not None:
            given = {i: brackets[i] for i in pending}
        else:
            given = None
        exprs = {}
        for i in ([] if given else pending):
            v, cond, r = targets[i][0].cast("double"), targets[i][1], targets[i][2]
            rel = (r - below[i]) / max(size[i] - 1, 1)
            eps = MARGIN / accuracy
            m = _region(v, lo[i], hi[i], cond)
            exprs[f"a{i}"] = F.percentile_approx(F.when(m, v), [max(rel - eps, 0.0), min(rel + eps, 1.0)], accuracy)
        if given:
            found = given
        else:
            (row,) = yield [Aggregate(exprs)]
            found = {i: row[f"a{i}"] for i in pending}
        # step 2: exact counts left of / at / inside / at the top of each bracket.
        # When the sketch's rank-error bound guarantees few values strictly
        # inside (region small enough), the one at the rank is picked in this same pass.
        exprs = {}
        eager = set()
        for i in pending:
            v, cond = targets[i][0].cast("double"), targets[i][1]
            b_lo, b_hi = found[i]
            base = v.isNotNull() if cond is None else (v.isNotNull() & cond)
            inside = base & (v > F.lit(b_lo)) & (v < F.lit(b_hi))
            exprs |= {f"b{i}": F.count_if(base & (v < F.lit(b_lo))), f"l{i}": F.count_if(base & (v == F.lit(b_lo))),
                      f"m{i}": F.count_if(inside), f"h{i}": F.count_if(base & (v == F.lit(b_hi)) & F.lit(b_hi != b_lo))}
            if EAGER_COLLECT and size[i] * (2 * MARGIN + 2) / accuracy <= room:
                eager.add(i)
                at = F.lit(targets[i][2]) - exprs[f"b{i}"] - exprs[f"l{i}"]
                exprs[f"v{i}"] = F.when((at >= 0) & (at < exprs[f"m{i}"]), F.get(F.sort_array(F.collect_list(F.when(inside, v))), at.cast("int")))
        (row,) = yield [Aggregate(exprs)]
        still = []
        for i in pending:
            r = targets[i][2]
            b_lo, b_hi = found[i]
            nb, nl, nm, nh = row[f"b{i}"], row[f"l{i}"], row[f"m{i}"], row[f"h{i}"]
            if r < nb:                       # answer < b_lo
                size[i] = nb - below[i]
                hi[i] = ("open", b_lo)
            elif r < nb + nl:                # answer == b_lo (ties resolve here)
                vals[i] = b_lo
                continue
            elif r < nb + nl + nm:           # answer strictly inside the bracket
                if i in eager:
                    vals[i] = row[f"v{i}"]
                    continue
                below[i], size[i] = nb + nl, nm
                lo[i], hi[i] = ("open", b_lo), ("open", b_hi)
            elif r < nb + nl + nm + nh:      # answer == b_hi
                vals[i] = b_hi
                continue
            else:                            # answer > b_hi
                end_ = below[i] + size[i]
                below[i] = nb + nl + nm + nh
                size[i] = end_ - below[i]
                lo[i] = ("open", b_hi)
            still.append(i)
        pending = still
    for i in pending:  # pathological data only: Spark's exact percentile on the region
        v, cond, r = targets[i][0].cast("double"), targets[i][1], targets[i][2]
        m = _region(v, lo[i], hi[i], cond)
        p = (r - below[i]) / max(size[i] - 1, 1)
        (row,) = yield [Aggregate({"p": F.percentile(F.when(m, v), F.lit(p))})]
        vals[i] = row["p"]
    return vals


def locate(v: Column, edges: list[float], at: int = 0) -> Column:
    """2 * (number of edges below v), plus 1 if v is an edge itself; null stays null.  A balanced tree of comparisons."""
    if not edges:
        return F.when(v.isNotNull(), F.lit(2 * at))
    mid = len(edges) // 2
    e = F.lit(edges[mid])
    return (F.when(v == e, F.lit(2 * (at + mid) + 1)).when(v < e, locate(v, edges[:mid], at))
            .otherwise(locate(v, edges[mid + 1:], at + mid + 1)))


def _interval_steps(targets: list[tuple], brackets: list, members: dict[int, list[int]], max_collect: int) -> Fit:
    """Values of the targets of some columns (group -> targets) by counted intervals; a target whose interval stays too full has none.

    Also gives, for those, (rows below the interval, rows in it, lower edge, upper edge).
    """
    found, wide, brackets = {}, {}, dict(enumerate(brackets))
    for _round in range(4):
        edges = {g: sorted({x for i in rows for x in brackets[i]}) for g, rows in members.items()}
        value = {g: targets[rows[0]][0].cast("double") for g, rows in members.items()}
        code = {g: locate(value[g], edges[g]) for g in members}
        counted = yield [Codes(code[g]) for g in members]
        wanted, wide, full = {}, {}, {}
        for (g, rows), counts in zip(members.items(), counted):
            below, start = 0, {}
            for k in sorted(counts):
                start[k] = below
                below += counts[k]
            for i in rows:
                k = max(x for x in start if start[x] <= targets[i][2])
                if k % 2:
                    found[i] = edges[g][k // 2]
                elif counts[k] <= max(max_collect, MAX_GROUP):
                    wanted.setdefault(g, {}).setdefault(k, []).append((targets[i][2] - start[k], i))
                else:
                    lo = ("open", edges[g][k // 2 - 1]) if k else None
                    hi = ("open", edges[g][k // 2]) if k // 2 < len(edges[g]) else None
                    wide[i] = (start[k], counts[k], lo, hi)
                    full.setdefault(g, {}).setdefault(k, []).append(i)
        asked = [Members(code[g], value[g], {k: sorted({at for at, _ in places}) for k, places in ks.items()}) for g, ks in wanted.items()]
        asked += [Cuts(code[g], value[g], sorted(ks)) for g, ks in full.items()]
        given = iter((yield asked) if asked else [])
        for g, ks in wanted.items():
            values = next(given)
            found.update({i: values[k, at] for k, places in ks.items() for at, i in places})
        if not wide:
            break
        for g, ks in full.items():
            cuts = next(given)
            for k, rows in ks.items():
                for i in rows:
                    below, n, _, _ = wide[i]
                    at = (targets[i][2] - below) / max(n - 1, 1) * GRID
                    brackets[i] = (cuts[k][max(math.floor(at) - 1, 0)], cuts[k][min(math.ceil(at) + 1, GRID)])
        members = {g: [i for rows in ks.values() for i in rows] for g, ks in full.items()}
    return found, wide


def _region(v: Column, lo, hi, cond: Column | None) -> Column:
    m = v.isNotNull()
    if cond is not None:
        m = m & cond
    if lo is not None:
        m = m & ((v > F.lit(lo[1])) if isinstance(lo, tuple) else (v >= F.lit(lo)))
    if hi is not None:
        m = m & ((v < F.lit(hi[1])) if isinstance(hi, tuple) else (v <= F.lit(hi)))
    return m


def bracket_exprs(cols: list, probs: list[float], prefix: str = "qb",
                  accuracy: int = ACCURACY) -> list[Column]:
    """Aggregate expressions a caller adds to its own pass: count and the
    approximate values just below/above each probability of each column."""
    return [e.alias(name) for name, e in bracket_dict(cols, probs, prefix, accuracy).items()]


def bracket_dict(cols: list, probs: list[float], prefix: str = "qb", accuracy: int = ACCURACY) -> dict[str, Column]:
    eps = MARGIN / accuracy
    grid = [x for p in probs for x in (max(p - eps, 0.0), min(p + eps, 1.0))]
    out = {}
    for j, e in enumerate(cols):
        e = F.col(e) if isinstance(e, str) else e
        out[f"{prefix}n{j}"] = F.count(e)
        out[f"{prefix}a{j}"] = F.percentile_approx(e.cast("double"), grid, accuracy)
    return out


def exact_quantiles(df: DataFrame, cols: list, probs: list[float],
                    conds: list | None = None, approx: bool = False,
                    accuracy: int = ACCURACY, pre_row=None, prefix: str = "qb") -> list[list[float | None]]:
    """Linear-interpolated quantiles (pandas/DuckDB semantics) for each column.

    ``cols`` are names or Column expressions.  ``approx=True`` returns
    ``percentile_approx`` in a single pass (no interpolation).  ``pre_row``
    is a Row holding ``bracket_exprs(cols, probs, prefix)`` computed by the
    caller's pass, which saves the first scan.
    Returns one list of values (one per prob) per column; None if no values.
    """
    return run(df, quantile_steps(cols, probs, conds, approx, accuracy, pre_row, prefix))


def quantile_steps(cols: list, probs: list[float], conds: list | None = None, approx: bool = False,
                   accuracy: int = ACCURACY, pre_row=None, prefix: str = "qb") -> Fit:
    """``exact_quantiles`` as a fit that shares its scans."""
    exprs = [F.col(c) if isinstance(c, str) else c for c in cols]
    conds = conds or [None] * len(exprs)
    if approx:
        (row,) = yield [Aggregate({f"p{j}": F.percentile_approx(_cond(e.cast("double"), cd), list(probs), accuracy)
                                   for j, (e, cd) in enumerate(zip(exprs, conds))})]
        return [list(row[f"p{j}"]) if row[f"p{j}"] is not None else [None] * len(probs)
                for j in range(len(exprs))]
    if pre_row is None:
        (pre_row,) = yield [Aggregate(bracket_dict([_cond(e, cd) for e, cd in zip(exprs, conds)], probs, prefix, accuracy))]
    targets, plan, brackets = [], [], []
    for j, (e, cd) in enumerate(zip(exprs, conds)):
        n = pre_row[f"{prefix}n{j}"]
        approx_vals = pre_row[f"{prefix}a{j}"]
        row_plan = []
        for k, p in enumerate(probs):
            if n == 0:
                row_plan.append(None)
                continue
            br = (approx_vals[2 * k], approx_vals[2 * k + 1])
            pos = (n - 1) * p
            a = int(math.floor(pos))
            b = min(a + 1, n - 1)
            frac = pos - a
            ia = len(targets)
            targets.append((e, cd, a, n, j))
            brackets.append(br)
            ib = ia
            if frac > 0 and b != a:
                ib = len(targets)
                targets.append((e, cd, b, n, j))
                brackets.append(br)
            row_plan.append((ia, ib, frac))
        plan.append(row_plan)
    vals = yield from order_steps(targets, accuracy=accuracy, brackets=brackets)
    out = []
    for row_plan in plan:
        res = []
        for item in row_plan:
            if item is None:
                res.append(None)
                continue
            ia, ib, frac = item
            res.append(lerp(vals[ia], vals[ib], frac) if ib != ia else vals[ia])
        out.append(res)
    return out


def lerp(a: float, b: float, t: float) -> float:
    """Linear interpolation exactly as numpy's quantile does it (the
    original runs pandas): from the nearer end, so t >= 0.5 counts from b."""
    d = b - a
    return b - d * (1.0 - t) if t >= 0.5 else a + d * t


def median(df: DataFrame, col, approx: bool = False) -> float | None:
    return exact_quantiles(df, [col], [0.5], approx=approx)[0][0]
