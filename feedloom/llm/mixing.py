"""Op 10: mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). Each marginal has target shares of all tokens; raking
scales the cells' token weights to one marginal after the other, round by round. After a round every value's misfit is its
share over its target share, less 1. Raking ends when the largest misfit is under ``TOLERANCE``, or when no misfit has
changed by ``SETTLED`` or more since the round before: targets that cannot all be met (a source in one language only, whose
two targets differ) end so, the last marginal met exactly, the others as nearly as the last round leaves them.
``rounds`` bounds the rounds. :func:`misfits` gives what is left, value by value; a misfit that stays is logged too.

The rule is one; it is computed in two places. Up to ``DRIVER_CELLS`` cells (a few numbers each) the rounds run on the
driver, which would otherwise cost several jobs a round. More cells are raked by factor tables: the scale of a cell is the
product of one factor per marginal, and every step is one aggregation of the cells joined with the others' factors. Both
have the same steps and the same test for the end; tests hold them against each other.

A document's probability is min(1, c * its cell's factor); none is repeated. c is solved so that ``share`` of all tokens (or
``budget`` tokens; all tokens at most) is expected to stay: cells whose documents would have to be repeated saturate
at 1, and a scarce cell lowers nobody else. With neither, c is one over the largest factor and nothing saturates.
Where cells saturate, the marginals kept are as near to the targets as documents that are not repeated allow.
A document is sampled if a fixed hash of its id is below its probability.

Default targets are token totals to the power ``flatten``. Cells are combined before the shuffle, so a
hot source is one row per language and topic; tables are written to the shared folder and
broadcast only if Spark sees there that they are under its threshold.

Null and empty marginal values are one value; documents without words (null text too) have probability 0.
Repeated rows are drawn alike (the draw depends on the id). Given targets that no document has are left out,
the others keeping their proportions; documents whose value has no given target have probability 0. Empty
tables give empty results.
"""

from __future__ import annotations

import logging
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import col, free_name, hash_share, others, packed, stored, table

FLATTEN, SHARE = 0.7, 0.5
TOLERANCE, SETTLED, ROUNDS = 1e-6, 1e-9, 2000
DRIVER_CELLS = 200_000
MARGINALS = ("source", "lang", "topic")
SHORT, LONG = 250, 1000  # words

log = logging.getLogger(__name__)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\r\n]+")), F.lit(0)).cast("long")


def size_topic(n_tokens: Column) -> Column:
    """The third marginal of the query: documents have no topic column, so their size class is taken."""
    return F.when(n_tokens < SHORT, "short").when(n_tokens < LONG, "medium").otherwise("long")


def fitted(done: int, rounds: int, misfit: float, change: float) -> bool:
    """Whether raking ends after ``done`` rounds; a misfit that stays is logged."""
    if misfit >= TOLERANCE and change >= SETTLED and done < rounds:
        return False
    if misfit >= TOLERANCE:
        log.warning("raking: after %d rounds a share is off its target by %.3g of it (%s)", done, misfit,
                    "the targets cannot all be met" if change < SETTLED else "it was still falling")
    return True


def shares(cells: DataFrame, m: str, targets: dict[str, DataFrame], flatten: float) -> DataFrame:
    """Rows (marginal value, goal) of one marginal; goals need not add up to 1."""
    if m in targets:
        return cells.select(m).distinct().join(targets[m].select(m, F.col("share").alias("goal")), m)
    return cells.groupBy(m).agg(F.pow(F.sum("tokens").cast("double"), F.lit(flatten)).alias("goal"))


def rake_here(cells: DataFrame, marginals, targets: dict[str, DataFrame], flatten: float, rounds: int) -> DataFrame:
    """:func:`rake` on the driver, for a bounded number of cells."""
    got = cells.select(*marginals, "tokens").toArrow()  # DRIVER_CELLS rows at most
    tokens = got["tokens"].to_numpy().astype(float)
    weight, codes, goals = tokens.copy(), [], []
    for m in marginals:
        coded = got[m].combine_chunks().dictionary_encode()
        codes.append(coded.indices.to_numpy())
        goal = {r[m]: r["goal"] for r in shares(cells, m, targets, flatten).collect()}  # no more than cells
        goals.append(np.array([goal[v] for v in coded.dictionary.to_pylist()], float))
    done, last = 0, [np.zeros(len(x)) for x in goals]
    while len(tokens):
        for code, goal in zip(codes, goals):
            now = np.bincount(code, weight, len(goal))
            weight *= np.divide(goal, now, out=np.zeros_like(now), where=now > 0)[code]
        done, off, total = done + 1, [], weight.sum() or 1.0
        for code, goal in zip(codes, goals):
            aim = goal / (goal.sum() or 1.0)
            off.append(np.divide(np.bincount(code, weight, len(goal)) / total, aim, out=np.ones_like(aim), where=aim > 0) - 1)
        change = max(np.abs(x - y).max() for x, y in zip(off, last))
        last = off
        if fitted(done, rounds, max(np.abs(x).max() for x in off), change):
            break
    out = got.append_column("factor", pa.array(weight / np.maximum(tokens, 1.0), pa.float64()))
    return cells.sparkSession.createDataFrame(out, schema=f"{', '.join(f'`{m}` string' for m in marginals)}, tokens long, factor double")


def misfits(raked: DataFrame, marginals=MARGINALS, targets: dict[str, DataFrame] | None = None, flatten: float = FLATTEN) -> DataFrame:
    """Rows (marginal, value, off): each value's share of the raked weight over its target share, less 1."""
    parts = []
    for m in marginals:
        goal = shares(raked, m, targets or {}, flatten)
        both = raked.groupBy(m).agg(F.sum(F.col("tokens") * F.col("factor")).alias("now")).join(goal, m)
        sums = both.agg(F.sum("now").alias("all_now"), F.sum("goal").alias("all_goal"))  # one row
        off = F.try_divide(F.try_divide("now", "all_now"), F.try_divide("goal", "all_goal")) - 1
        parts.append(both.crossJoin(F.broadcast(sums)).select(F.lit(m).alias("marginal"), F.col(m).alias("value"), F.coalesce(off, F.lit(0.0)).alias("off")))
    return reduce(DataFrame.unionByName, parts)


def rake(cells: DataFrame, marginals, targets: dict[str, DataFrame], flatten: float, rounds: int) -> DataFrame:
    """The cells (those that all targets have) with ``factor``: raked weight per token, up to a common scale."""
    goals = {m: stored(shares(cells, m, targets, flatten), f"goal-{m}") for m in marginals}
    factors: dict[str, DataFrame] = {}

    def weighed(names) -> DataFrame:
        out, product = cells, F.lit(1.0)
        for m in names:
            out, product = out.join(factors[m], m), product * F.col(f"f_{m}")
        return out.select(*marginals, "tokens", product.alias("factor"))

    done, last = 0, None
    while True:
        for m in marginals:
            rest = weighed([x for x in marginals if x != m and x in factors])
            now = rest.groupBy(m).agg(F.sum(F.col("tokens") * F.col("factor")).alias("now"))
            factors[m] = stored(now.join(goals[m], m).select(m, F.coalesce(F.try_divide("goal", "now"), F.lit(0.0)).alias(f"f_{m}")), f"factor-{m}")
        done += 1
        off = stored(misfits(weighed(marginals), marginals, targets, flatten), "misfits")
        both = off.withColumn("was", F.lit(0.0)) if last is None else off.join(last, ["marginal", "value"])
        seen = both.agg(F.max(F.abs("off")).alias("misfit"), F.max(F.abs(F.col("off") - F.col("was"))).alias("change")).first()
        last = off.withColumnRenamed("off", "was")
        if fitted(done, rounds, seen["misfit"] or 0.0, seen["change"] or 0.0):
            return weighed(marginals)


def scale_for(raked: DataFrame, goal: float) -> float:
    """c so that the sum of tokens * min(1, c * factor) is ``goal`` (all tokens at most): one aggregation a step.

    Cells that saturate stay saturated as c grows, so the steps end."""
    scale = 0.0
    while True:
        full = F.col("factor") * scale >= 1
        x = raked.filter("factor > 0").agg(
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)).alias("whole"), F.min("factor").alias("least"),
            F.sum(F.when(~full, F.col("tokens") * F.col("factor"))).alias("open")).first()
        if x["least"] is None:
            return 0.0
        if not x["open"] or goal <= x["whole"]:
            return 1.0 / x["least"] if not x["open"] else scale
        new = (goal - x["whole"]) / x["open"]
        if new <= scale * (1 + 1e-12):
            return scale
        scale = new


def mix(df: DataFrame, n_tokens: str = "n_tokens", key: str = "doc_id", marginals=MARGINALS,
        targets: dict[str, DataFrame] | None = None, flatten: float = FLATTEN, rounds: int = ROUNDS,
        budget: float | None = None, share: float | None = None) -> DataFrame:
    """Add ``probability`` and ``sampled``. ``targets``: for some marginals, rows (marginal, share)."""
    keys = {m: F.coalesce(col(m).cast("string"), F.lit("")) for m in marginals}
    cells = stored(df.select(*[e.alias(m) for m, e in keys.items()], col(n_tokens).alias("n")).filter("n > 0")
                   .groupBy(*marginals).agg(F.sum("n").alias("tokens")), "cells")
    want = {m: t.groupBy(F.coalesce(F.col(m).cast("string"), F.lit("")).alias(m)).agg(F.sum("share").alias("share"))
            for m, t in (targets or {}).items()}
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    aimed = cells
    for m in want:
        aimed = aimed.join(want[m].select(m), m, "left_semi")
    way = rake_here if cells.limit(DRIVER_CELLS + 1).count() <= DRIVER_CELLS else rake
    raked = stored(way(aimed, marginals, want, flatten, rounds), "raked")
    if budget is not None or share is not None:
        scale = scale_for(raked, budget if budget is not None else share * total)
    else:
        top = raked.agg(F.max("factor").alias("top")).first()["top"]
        scale = 1.0 / top if top else 0.0
    chance = free_name(df, "_chance")
    rates = raked.select(*[F.col(m).alias(f"_of_{m}") for m in marginals], F.least(F.lit(1.0), F.col("factor") * scale).alias(chance))
    match = [keys[m] == F.col(f"_of_{m}") for m in marginals]
    p = F.round(F.when(col(n_tokens) > 0, F.col(chance)).otherwise(0.0), 9)
    out = df.join(rates, match, "left").withColumn(chance, F.coalesce(p, F.lit(0.0)))
    return out.select(*others(df, ["probability", "sampled"]), F.col(chance).alias("probability"),
                      (hash_share(col(key)) < F.col(chance)).alias("sampled"))


def with_size(df: DataFrame) -> DataFrame:
    return df.withColumn("n_tokens", words(F.col("text"))).withColumn("topic", size_topic(F.col("n_tokens"))).drop("text")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mix(with_size(docs), share=SHARE).select("doc_id", "topic", "n_tokens", "probability", "sampled")


def oracle(flatten: float = FLATTEN, share: float = SHARE) -> str:
    """The same rule in SQL: rounds as a recursive query that carries the cells, then c from the cells by falling factor."""
    goals = ", ".join(f"g_{m} AS MATERIALIZED (SELECT {m}, pow(sum(tokens)::DOUBLE, {flatten}) AS goal FROM cells GROUP BY {m})" for m in MARGINALS)
    inner = "SELECT *, w AS w0 FROM rake WHERE NOT done"
    for k, m in enumerate(MARGINALS):
        inner = f"SELECT *, w{k} * goal_{m} / sum(w{k}) OVER (PARTITION BY {m}) AS w{k + 1} FROM ({inner})"
    last = f"w{len(MARGINALS)}"
    fresh = ", ".join(f"sum({last}) OVER (PARTITION BY {m}) / sum({last}) OVER () / aim_{m} - 1 AS new_{m}" for m in MARGINALS)
    worst = lambda terms: f"max(greatest({', '.join(terms)})) OVER ()"
    ends = [f"{worst(f'abs(new_{m})' for m in MARGINALS)} < {TOLERANCE}", f"{worst(f'abs(new_{m} - off_{m})' for m in MARGINALS)} < {SETTLED}"]
    kept = ", ".join([*MARGINALS, "tokens", *(f"goal_{m}, aim_{m}" for m in MARGINALS)])
    return f"""
        WITH RECURSIVE sized AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
                coalesce(len(regexp_extract_all(text, '[^ \\t\\r\\n]+')), 0)::BIGINT AS n_tokens FROM documents),
        d AS MATERIALIZED (SELECT *, CASE WHEN n_tokens < {SHORT} THEN 'short' WHEN n_tokens < {LONG} THEN 'medium'
                ELSE 'long' END AS topic FROM sized),
        cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM d WHERE n_tokens > 0 GROUP BY ALL),
        {goals},
        rake AS (
            SELECT 0 AS round, source, lang, topic, tokens, {", ".join(f"g_{m}.goal AS goal_{m}, g_{m}.goal / (SELECT sum(goal) FROM g_{m}) AS aim_{m}" for m in MARGINALS)},
                   tokens::DOUBLE AS w, {", ".join(f"0::DOUBLE AS off_{m}" for m in MARGINALS)}, false AS done
            FROM cells {" ".join(f"JOIN g_{m} USING ({m})" for m in MARGINALS)}
            UNION ALL
            SELECT round + 1, {kept}, {last}, {", ".join(f"new_{m}" for m in MARGINALS)}, {" OR ".join(ends)} OR round + 1 >= {ROUNDS}
            FROM (SELECT *, {fresh} FROM ({inner}))),
        raked AS MATERIALIZED (SELECT source, lang, topic, tokens, w / tokens AS factor FROM rake WHERE round = (SELECT max(round) FROM rake)),
        steps AS (SELECT factor, ({share} * sum(tokens) OVER () - (sum(tokens) OVER down - tokens)) / sum(tokens * factor) OVER up AS c,
                         row_number() OVER down AS place
                  FROM raked WINDOW down AS (ORDER BY factor DESC, source, lang, topic ROWS UNBOUNDED PRECEDING),
                                    up AS (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        scale AS (SELECT arg_min(c, place) AS c FROM steps WHERE c * factor <= 1),
        p AS (SELECT d.*, coalesce(round(CASE WHEN n_tokens > 0 THEN least(1.0, factor * c) ELSE 0.0 END, 9), 0.0) AS probability
              FROM d LEFT JOIN raked USING (source, lang, topic) LEFT JOIN scale ON true)
        SELECT doc_id, topic, n_tokens, probability,
               ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 < probability AS sampled FROM p"""


def stage_mixing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents."""
    rows = with_size(packed(docs, *dict.fromkeys(("doc_id", "source", "lang", "text"))))
    return mix(rows, share=SHARE).filter("sampled").select("row.*")
