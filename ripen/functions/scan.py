"""Shared scans: fits as generators that ask for aggregates and are answered together.

A fit yields requests and is resumed with their answers, in the same order:

* ``Aggregate``: named aggregate expressions, answered by a dict of values;
* ``Top``: the k most frequent non-null values of an expression (count
  descending, value ascending), answered by a list of values;
* ``Codes``: the rows of each value of an integer expression with few values,
  answered by a dict (null is left out);
* ``Members``: of the numbers of the rows that have one of some codes, those at
  given places of their order, answered by a dict ((code, place) -> value);
* ``Cuts``: the quantiles of those numbers on a grid of ``GRID`` steps (a bounded sketch
  for each code), answered by a dict (code -> values);
* ``Levels``: all values of a text expression, answered by a table (__v, __n,
  __code) of counts and codes in value order.

The most frequent values are found without shuffling all values: a frequent-items
sketch (bounded, merged like any aggregate) names candidates, a second pass counts
exactly those, and the answer stands only if no other value can reach it:
all rows are counted, or the k-th count is above what the sketch can have missed.
Columns for which that does not hold (flat or id-like ones) are counted in full.

``drive`` advances any number of fits in rounds.  A round answers all requests
that are open with one aggregate over the table, two for all ``Top`` requests (and a
long-form count for those not settled), one grouping for all ``Codes``, one for all ``Members``, one for all ``Cuts`` and one for all ``Levels``; how many scans are made
depends on the longest fit, not on the number of fits.
"""

from __future__ import annotations

from collections.abc import Callable, Generator
from dataclasses import dataclass
from functools import wraps
from typing import Any

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .lookup import dense_codes

#: scans made since the start: aggregates and counts over a table (read it before and after to compare plans)
scans = {"aggregate": 0, "top": 0, "codes": 0, "members": 0, "cuts": 0, "levels": 0}


TRACKED = 4096            # values that a sketch follows
SKETCH_ERROR = 3.5        # times the rows, over the values followed: what a count can be off by
GRID = 1000
SKETCHED = {"string", "tinyint", "smallint", "int", "bigint", "boolean", "date"}


@dataclass
class Aggregate:
    exprs: dict[str, Column]


@dataclass
class Top:
    value: Column
    k: int


@dataclass
class Codes:
    value: Column


@dataclass
class Members:
    code: Column
    value: Column
    wanted: dict[int, list[int]]


@dataclass
class Cuts:
    code: Column
    value: Column
    wanted: list[int]


@dataclass
class Levels:
    value: Column


Fit = Generator[list, list, Any]


def drive(df: DataFrame, fits: list[Fit]) -> list:
    """The result of each fit, or the ValueError that it raised."""
    results: list = [None] * len(fits)
    answers: dict[int, Any] = {i: None for i in range(len(fits))}
    while answers:
        asked: dict[int, list] = {}
        for i, given in answers.items():
            try:
                asked[i] = fits[i].send(given)
            except StopIteration as done:
                results[i] = done.value
            except ValueError as e:
                results[i] = e
        answers = _answer(df, asked)
    return results


def _answer(df: DataFrame, asked: dict[int, list]) -> dict[int, list]:
    out: dict[int, list] = {i: [None] * len(requests) for i, requests in asked.items()}
    every = [(i, j, r) for i, requests in asked.items() for j, r in enumerate(requests)]
    named = [(i, j, name, e) for i, j, r in every if isinstance(r, Aggregate) for name, e in r.exprs.items()]
    if named:
        scans["aggregate"] += 1
        row = df.agg(*[e.alias(f"x{k}") for k, (*_, e) in enumerate(named)]).first()
        for k, (i, j, name, _) in enumerate(named):
            if out[i][j] is None:
                out[i][j] = {}
            out[i][j][name] = row[f"x{k}"]
    for i, j, r in every:
        if isinstance(r, Aggregate) and out[i][j] is None:
            out[i][j] = {}
    top = [(i, j, r) for i, j, r in every if isinstance(r, Top)]
    by_type: dict[str, list] = {}
    for (i, j, r), f in zip(top, df.select(*[r.value.alias(f"x{k}") for k, (*_, r) in enumerate(top)]).schema.fields if top else ()):
        by_type.setdefault(f.dataType.simpleString(), []).append((i, j, r))
    for kind, group in by_type.items():
        settled = _frequent(df, [r for *_, r in group]) if kind in SKETCHED else [None] * len(group)
        for (i, j, _), values in zip(group, settled):
            out[i][j] = values
        group = [x for x, values in zip(group, settled) if values is None]
        if group:
            scans["top"] += 1
            counts = unpivoted(df, [r.value for *_, r in group]).where("__v is not null").groupBy("__slot", "__v").agg(F.count(F.lit(1)).alias("__n"))
            most = max(r.k for *_, r in group)
            w = W.partitionBy("__slot").orderBy(F.col("__n").desc(), F.col("__v").asc())
            rows = counts.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= most).collect()
            for s, (i, j, r) in enumerate(group):
                found = sorted((x["__r"], x["__v"]) for x in rows if x["__slot"] == s)
                out[i][j] = [v for _, v in found[:r.k]]
    codes = [(i, j, r) for i, j, r in every if isinstance(r, Codes)]
    if codes:
        for (i, j, _), counts in zip(codes, _code_counts(df, [r.value.cast("int") for *_, r in codes])):
            out[i][j] = counts
    members = [(i, j, r) for i, j, r in every if isinstance(r, Members)]
    if members:
        for (i, j, _), values in zip(members, _members(df, [r for *_, r in members])):
            out[i][j] = values
    cuts = [(i, j, r) for i, j, r in every if isinstance(r, Cuts)]
    if cuts:
        for (i, j, _), values in zip(cuts, _cuts(df, [r for *_, r in cuts])):
            out[i][j] = values
    levels = [(i, j, r) for i, j, r in every if isinstance(r, Levels)]
    if levels:
        scans["levels"] += 1
        counts = unpivoted(df, [r.value for *_, r in levels]).groupBy("__slot", "__v").agg(F.count(F.lit(1)).alias("__n"))
        coded = dense_codes(counts, ["__slot", "__v"], "__code")
        first = {r["__slot"]: r["lo"] for r in coded.groupBy("__slot").agg(F.min("__code").alias("lo")).collect()}
        for s, (i, j, _) in enumerate(levels):
            out[i][j] = (coded.where(F.col("__slot") == s)
                         .select("__v", "__n", (F.col("__code") - F.lit(first.get(s, 0))).cast("bigint").alias("__code")))
    return out


def _code_counts(df: DataFrame, codes: list[Column]) -> list[dict[int, int]]:
    scans["codes"] += 1
    rows = unpivoted(df, codes).where("__v is not null").groupBy("__slot", "__v").agg(F.count(F.lit(1)).alias("__n")).collect()
    return [{x["__v"]: x["__n"] for x in rows if x["__slot"] == s} for s in range(len(codes))]


def _picked(df: DataFrame, asked: list[Members] | list[Cuts]) -> DataFrame:
    """(__slot, __k, __x): a code is worked out once a row and column, and only rows with a wanted one are left."""
    coded = df.select(*[x for s, r in enumerate(asked) for x in (r.code.cast("int").alias(f"k{s}"), r.value.cast("double").alias(f"v{s}"))])
    picked = [F.when(F.col(f"k{s}").isin(list(r.wanted)), F.struct(F.col(f"k{s}").alias("k"), F.col(f"v{s}").alias("v"))) for s, r in enumerate(asked)]
    return unpivoted(coded, picked).where("__v is not null").select("__slot", F.col("__v")["k"].alias("__k"), F.col("__v")["v"].alias("__x"))


def _members(df: DataFrame, asked: list[Members]) -> list[dict[tuple[int, int], float]]:
    """Values are sorted in their group; only those at the places asked for reach the driver."""
    scans["members"] += 1
    places = F.create_map(*[x for s, r in enumerate(asked) for k, at in r.wanted.items() for x in (F.lit(f"{s}:{k}"), F.lit(at))])
    rows = (_picked(df, asked).groupBy("__slot", "__k").agg(F.sort_array(F.collect_list("__x")).alias("__all"))
            .select("__slot", "__k", F.transform(places[F.concat_ws(":", "__slot", "__k")], lambda at: F.get("__all", at)).alias("__at")).collect())
    return [{(x["__k"], at): v for x in rows if x["__slot"] == s for at, v in zip(r.wanted[x["__k"]], x["__at"])} for s, r in enumerate(asked)]


def _cuts(df: DataFrame, asked: list[Cuts]) -> list[dict[int, list[float]]]:
    scans["cuts"] += 1
    rows = (_picked(df, asked).groupBy("__slot", "__k")
            .agg(F.percentile_approx("__x", [i / GRID for i in range(GRID + 1)], 10 * GRID).alias("__at")).collect())
    return [{x["__k"]: x["__at"] for x in rows if x["__slot"] == s} for s in range(len(asked))]


def _frequent(df: DataFrame, asked: list[Top]) -> list[list | None]:
    """The k most frequent values of each expression, or None where the sketch can't prove them."""
    scans["aggregate"] += 1
    most = [2 * r.k + 8 for r in asked]
    row = df.agg(*[x for s, r in enumerate(asked) for x in
                   (F.count(r.value).alias(f"n{s}"), F.call_function("approx_top_k", r.value, F.lit(most[s]), F.lit(TRACKED)).alias(f"t{s}"))]).first()
    named = [[x["item"] for x in row[f"t{s}"] or () if x["item"] is not None] for s in range(len(asked))]
    counted = _code_counts(df, [F.array_position(F.lit(v), r.value).cast("int") if v else F.lit(None).cast("int") for v, r in zip(named, asked)]) if any(named) else [{}] * len(asked)
    out: list[list | None] = []
    for s, r in enumerate(asked):
        n = row[f"n{s}"]
        exact = sorted((-counted[s].get(i + 1, 0), v) for i, v in enumerate(named[s]))
        whole = sum(-k for k, _ in exact) == n
        # a value that is not named has at most twice the sketch's error, or the estimate of the last one named
        missed = max(2 * SKETCH_ERROR / TRACKED * n, row[f"t{s}"][-1]["count"] if len(named[s]) == most[s] else 0)
        proven = whole or len(exact) >= r.k and -exact[r.k - 1][0] > missed
        out.append([v for _, v in exact[:r.k]] if proven else None)
    return out


def unpivoted(df: DataFrame, values: list[Column], keep: list[Column] = ()) -> DataFrame:
    """(keep, __slot, __v): every value of expressions of one type; hot values merge in the map-side combine."""
    kept = df.select(*keep).columns if keep else []
    if len(values) == 1:
        return df.select(*keep, F.lit(0).alias("__slot"), values[0].alias("__v"))
    slots = df.select(*keep, *[v.alias(f"__v{k}") for k, v in enumerate(values)]).unpivot(kept, [f"__v{k}" for k in range(len(values))], "__name", "__v")
    return slots.select(*kept, F.substring("__name", 4, 9).cast("int").alias("__slot"), "__v")


def run(df: DataFrame, fit: Fit):
    """The result of one fit; its ValueError is raised."""
    (result,) = drive(df, [fit])
    if isinstance(result, ValueError):
        raise result
    return result


def on_its_own(steps: Callable[..., Fit]) -> Callable:
    """``f(df, ...)`` of a generator function whose fit starts from the table."""
    @wraps(steps)
    def call(df: DataFrame, *args, **kwargs):
        return run(df, steps(df, *args, **kwargs))
    call.steps = steps
    return call
