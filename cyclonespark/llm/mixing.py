"""Mixing sources to target weights [native]: iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked to target marginals of
sources, languages and topics; a document is then drawn with its cell's calibrated
probability.  The cells, not the documents, go through the rounds; a document meets its
cell in one join.

``rake`` cuts p at 1 after its rounds (what op7_mixing's SQL says), so a sample drawn by it misses the targets of groups
that would need more.  ``rake_bounded`` holds p <= 1 within the rounds, for given or tempered targets: cells at 1 stay
there while the others are raked, to a tolerance, and the sample is made smaller only as far as the
targets cannot be met otherwise.  Its cells, a row each, are raked on the driver.

Nulls and edge cases: null sources and languages are the group '' each; a null or blank text has no
tokens, topic 'prose', and shares its cell's probability (a cell without tokens keeps
everything); repeated rows with one doc_id are drawn alike; an empty table gives no rows;
extra columns are kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclonespark.llm.common import SPACE_RE, checkpoint

#: (topic, pieces of text any of which marks it), first match wins
TOPICS = (
    ("legal", ("Licensed under", "Copyright", "All rights reserved", "©")),
    ("contact", ("@", "+1 (")),
    ("tabular", (" | ",)),
)
ROUNDS = 6
#: marginal targets are the tokens of a group to this power, scaled to the total
TEMPER = 0.7
#: share of the tokens that the sample aims at
KEEP = 0.7
#: cells of up to so many rows are broadcast to the documents, more are shuffled
BROADCAST_CELLS = 10_000
MARGINS = ("source", "lang", "topic")
#: a group's share of the sample may miss its target by this part of it; rounds and halvings of the bounded raking at most
TOLERANCE, MOST_ROUNDS, HALVINGS = 0.005, 400, 10


def topic(text: Column, topics=TOPICS) -> Column:
    """Topic of a text by the table of marks, 'prose' without one."""
    out = F.lit("prose")
    for name, marks in reversed(topics):
        hit = F.lit(False)
        for m in marks:
            hit = hit | F.contains(text, F.lit(m))
        out = F.when(F.coalesce(hit, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """Number of words."""
    body = F.coalesce(F.regexp_replace(text, rf"^{SPACE_RE}|{SPACE_RE}$", ""), F.lit(""))
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, SPACE_RE))).cast("long")


def unit_draw(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the doc_id alone (null: as 'null')."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def rake(cells: DataFrame, rounds: int = ROUNDS, temper: float = TEMPER, keep: float = KEEP) -> DataFrame:
    """``cells(source, lang, topic, tokens)`` to the same with ``weight`` (raked tokens) and ``p``.

    Target of a group: its tokens ** temper, scaled so that the targets of a margin sum to
    all tokens.  ``p`` is min(1, weight / tokens * keep), so that the raked proportions hold wherever
    no probability reaches 1.
    """
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    totals = cells.groupBy().agg(F.sum("tokens").cast("double").alias("total"))
    for margin in MARGINS:
        group = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("group_tokens"))
        group = group.withColumn("power", F.pow("group_tokens", F.lit(temper)))
        scale = group.groupBy().agg(F.sum("power").alias("powers")).crossJoin(totals)
        target = group.crossJoin(scale).select(margin, (F.col("power") / F.col("powers") * F.col("total")).alias(f"to_{margin}"))
        cells = cells.join(target, margin)
    cells = checkpoint(cells)
    for _ in range(rounds):
        for margin in MARGINS:
            now = F.sum("weight").over(Window.partitionBy(margin))
            cells = cells.withColumn("weight", F.coalesce(F.try_divide(F.col("weight") * F.col(f"to_{margin}"), now), F.lit(0.0)))
    p = F.coalesce(F.least(F.lit(1.0), F.try_divide(F.col("weight") * F.lit(keep), F.col("tokens").cast("double"))), F.lit(1.0))
    return checkpoint(cells.select(*MARGINS, "tokens", "weight", p.alias("p")))


def _shares(tokens: np.ndarray, groups: list[np.ndarray], named: list[dict[int, float]], temper: float) -> list[np.ndarray]:
    """Target share of each group: the named ones, the others share the rest by tokens ** temper; groups without tokens get none."""
    out = []
    for group, given in zip(groups, named, strict=True):
        have = np.bincount(group, tokens)
        power = np.where(have > 0, have**temper, 0.0)
        fixed = np.zeros(len(have))
        for g, share in given.items():
            fixed[g], power[g] = share if have[g] > 0 else 0.0, 0.0
        rest = max(0.0, 1 - fixed.sum()) if power.sum() > 0 else 0.0
        share = fixed + (power / power.sum() * rest if rest else 0.0)
        if share.sum() <= 0:
            raise ValueError("targets leave no group with tokens")
        out.append(share / share.sum())
    return out


def _factor(x: np.ndarray, tokens: np.ndarray, goal: float, bound: bool) -> float:
    """The f for which tokens * min(1, f * x) sum to ``goal`` (without ``bound``: tokens * f * x)."""
    on = x > 0
    x, tokens = x[on], tokens[on]
    if not len(x):
        return 1.0
    if not bound:
        return goal / (tokens @ x)
    if goal >= tokens.sum():
        return max(1.0, 1 / x.min())
    order = np.argsort(-x)
    x, tokens = x[order], tokens[order]
    full = np.concatenate([[0.0], np.cumsum(tokens)[:-1]])  # tokens of the cells at 1, if the first so many are
    rest = np.cumsum((tokens * x)[::-1])[::-1]
    f = (goal - full) / rest
    return float(f[np.argmax(f * x <= 1 + 1e-12)])


def _raked(tokens: np.ndarray, groups: list[np.ndarray], shares: list[np.ndarray], keep: float, bound: bool) -> tuple[np.ndarray, float]:
    """p of the cells, and the largest part of its target by which a group's share misses it."""
    goal = tokens.sum() * keep
    cells = [[np.flatnonzero(group == g) for g in range(len(share))] for group, share in zip(groups, shares, strict=True)]
    x, miss = np.full(len(tokens), keep), np.inf
    for i in range(MOST_ROUNDS):
        for of, share in zip(cells, shares, strict=True):
            for g, at in enumerate(of):
                x[at] = np.minimum(x[at] * _factor(x[at], tokens[at], share[g] * goal, bound), 1e100)
        if i % 5 == 4:
            p = np.minimum(x, 1.0) if bound else x
            drawn = tokens * p
            sums = [np.bincount(group, drawn, len(share)) / drawn.sum() for group, share in zip(groups, shares, strict=True)]
            miss = max(float(np.max(np.abs(s - share) / np.where(share > 0, share, 1.0))) for s, share in zip(sums, shares, strict=True))
            if miss <= TOLERANCE:
                break
    return (np.minimum(x, 1.0) if bound else x), miss


def calibrated(tokens: np.ndarray, groups: list[np.ndarray], shares: list[np.ndarray], keep: float) -> np.ndarray:
    """p <= 1 of the cells, so that the drawn tokens have the target shares; as many as ``keep`` asks for, or as the targets allow.

    Where no weights at all meet the targets (they contradict each other), the sample comes as near as those without a bound.
    """
    total = tokens.sum()
    most = min(keep, *(float(np.min((np.bincount(g, tokens, len(s)) / np.where(s > 0, s * total, np.nan))[s > 0])) for g, s in zip(groups, shares, strict=True)))
    p, miss = _raked(tokens, groups, shares, most, True)
    if miss <= TOLERANCE:
        return p
    free, near = _raked(tokens, groups, shares, most, False)
    near = max(TOLERANCE, near * 1.01)
    if miss <= near:
        return p
    # so small a sample needs no bound
    low, high = most / max(1.0, float(free.max())), most
    best = free * (low / most)
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        p, miss = _raked(tokens, groups, shares, middle, True)
        if miss <= near:
            low, best = middle, p
        else:
            high = middle
    return np.minimum(best, 1.0)


def rake_bounded(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, keep: float = KEEP) -> DataFrame:
    """``cells(source, lang, topic, tokens)`` with ``p`` <= 1, by which a drawn sample has the target shares of tokens.

    ``targets``: by margin, the shares of named groups ('' for null); groups not named share the rest by tokens ** temper.
    """
    rows = cells.select(*MARGINS, "tokens").collect()
    tokens = np.array([float(r["tokens"]) for r in rows])
    p = np.ones(len(rows))
    on = np.flatnonzero(tokens > 0)
    if len(on):
        groups, named = [], []
        for margin in MARGINS:
            names, group = np.unique([rows[i][margin] for i in on], return_inverse=True)
            at = {n: g for g, n in enumerate(names.tolist())}
            groups.append(group)
            named.append({at[n]: float(v) for n, v in (targets or {}).get(margin, {}).items() if n in at})
        p[on] = calibrated(tokens[on], groups, _shares(tokens[on], groups, named, temper), keep)
    schema = "source string, lang string, topic string, tokens long, p double"
    return cells.sparkSession.createDataFrame([(*r, float(x)) for r, x in zip(rows, p, strict=True)], schema)


def mix(docs: DataFrame, rounds: int = ROUNDS, temper: float = TEMPER, keep: float = KEEP, text: str = "text", targets: dict[str, dict[str, float]] | None = None, bounded: bool = False) -> DataFrame:
    """``docs`` with _topic, _tokens, _p (probability) and _kept (drawn).

    With ``bounded`` or ``targets`` the cells are raked by ``rake_bounded``, else by ``rake``.
    """
    group = {m: F.coalesce(F.col(m).cast("string"), F.lit("")) for m in ("source", "lang")}
    rows = docs.withColumn("_topic", topic(F.col(text))).withColumn("_tokens", tokens(F.col(text)))
    cells = rows.groupBy(group["source"].alias("source"), group["lang"].alias("lang"), F.col("_topic").alias("topic")).agg(F.sum("_tokens").alias("tokens"))
    fitted = rake_bounded(cells, targets, temper, keep) if bounded or targets else rake(cells, rounds, temper, keep)
    fitted = fitted.select(F.col("source").alias("_cs"), F.col("lang").alias("_cl"), F.col("topic").alias("_ct"), F.col("p").alias("_p"))
    if fitted.count() <= BROADCAST_CELLS:
        fitted = F.broadcast(fitted)
    on = (group["source"] == F.col("_cs")) & (group["lang"] == F.col("_cl")) & (F.col("_topic") == F.col("_ct"))
    out = rows.join(fitted, on, "left").drop("_cs", "_cl", "_ct")
    return out.withColumn("_kept", unit_draw(F.col("doc_id")) < F.col("_p"))


def oracle_sql(rounds: int = ROUNDS, temper: float = TEMPER, keep: float = KEEP, source: str = "documents") -> str:
    """DuckDB SQL for doc_id, topic, tokens, p (6 decimals) and kept of ``source``."""
    cases = " ".join("WHEN " + " OR ".join(f"contains(text, '{m}')" for m in marks) + f" THEN '{name}'" for name, marks in TOPICS)
    steps = []
    last = "c0"
    for r in range(rounds):
        for m in MARGINS:
            steps.append(f"w{r}_{m} AS (SELECT * REPLACE (coalesce(weight * to_{m} / nullif(sum(weight) OVER (PARTITION BY {m}), 0), 0) AS weight) FROM {last})")
            last = f"w{r}_{m}"
    margins = ", ".join(f"t_{m} AS (SELECT {m}, pow(sum(tokens)::DOUBLE, {temper}) / (SELECT sum(p) FROM (SELECT pow(sum(tokens)::DOUBLE, {temper}) AS p FROM cells GROUP BY {m})) * (SELECT sum(tokens)::DOUBLE FROM cells) AS to_{m} FROM cells GROUP BY {m})" for m in MARGINS)
    joins = " ".join(f"JOIN t_{m} USING ({m})" for m in MARGINS)
    chain = ", ".join(steps)
    return (
        f"WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, CASE {cases} ELSE 'prose' END AS topic, "
        "coalesce(len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')), 0)::BIGINT AS tokens "
        f"FROM {source}), cells AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM d GROUP BY ALL), {margins}, "
        f"c0 AS (SELECT cells.*, tokens::DOUBLE AS weight, to_source, to_lang, to_topic FROM cells {joins}), {chain}, "
        f"p AS (SELECT source, lang, topic, coalesce(least(1.0, weight * {keep} / nullif(tokens, 0)), 1.0) AS p FROM {last}) "
        "SELECT doc_id, topic, tokens, round(p, 6) AS p, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / 281474976710656.0 < p AS kept "
        "FROM d JOIN p USING (source, lang, topic)"
    )
