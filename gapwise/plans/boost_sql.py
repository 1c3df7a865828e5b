"""SQL text that boosts trees the plain way, to check the trainer against.

Written from the definition of the split gain, round by round and level by level, over a
``train`` table ``k, x0, x1, ..., y``. It shares no code with the trainer.
"""

from __future__ import annotations

_SCALE = 2.0**30


def _binned(cuts: list[list[float]]) -> str:
    parts = []
    for i, points in enumerate(cuts):
        count = " + ".join(f"(x{i} >= {p!r})::INT" for p in points)
        parts.append(f"CASE WHEN x{i} IS NULL THEN -1 ELSE {count} END AS b{i}")
    return f"state_1 AS MATERIALIZED (SELECT k, y, {', '.join(parts)}, 0.0::DOUBLE AS m FROM train)"


def _level(r: int, d: int, size: int) -> list[str]:
    source = f"(SELECT *, 1 AS node FROM state_{r})" if d == 0 else f"routed_{r}_{d - 1}"
    bins = ", ".join(f"b{i}" for i in range(size))
    derived = f"""derived_{r}_{d} AS MATERIALIZED (
      SELECT k, y, m, {bins}, node, CAST(round((p - y) * {_SCALE}::DOUBLE) AS BIGINT) AS g,
        CAST(round(2 * p * (1 - p) * {_SCALE}::DOUBLE) AS BIGINT) AS h
      FROM (SELECT *, 1 / (1 + exp(-2 * m)) AS p FROM {source}))"""
    lines = " UNION ALL ".join(
        f"SELECT node, {i} AS feature, b{i} AS bin, sum(g)::DOUBLE AS g, sum(h)::DOUBLE AS h FROM derived_{r}_{d} "
        f"WHERE node >= {2**d} GROUP BY node, b{i}"
        for i in range(size)
    )
    sums = f"""sums_{r}_{d} AS MATERIALIZED (
      SELECT a.node, a.feature, a.bin,
        (SELECT sum(t.g) FROM hist_{r}_{d} t WHERE t.node = a.node AND t.feature = a.feature) / {_SCALE} AS tg,
        (SELECT sum(t.h) FROM hist_{r}_{d} t WHERE t.node = a.node AND t.feature = a.feature) / {_SCALE} AS th,
        sum(CASE WHEN b.bin >= 0 AND b.bin <= a.bin THEN b.g ELSE 0 END) / {_SCALE} AS pg,
        sum(CASE WHEN b.bin >= 0 AND b.bin <= a.bin THEN b.h ELSE 0 END) / {_SCALE} AS ph,
        sum(CASE WHEN b.bin = -1 THEN b.g ELSE 0 END) / {_SCALE} AS ng,
        sum(CASE WHEN b.bin = -1 THEN b.h ELSE 0 END) / {_SCALE} AS nh
      FROM hist_{r}_{d} a JOIN hist_{r}_{d} b ON a.node = b.node AND a.feature = b.feature
      GROUP BY a.node, a.feature, a.bin)"""
    sides = " UNION ALL ".join(
        f"SELECT node, feature, bin, {flag} AS default_left, tg, th, pg{g} AS lg, ph{h} AS lh FROM sums_{r}_{d}"
        for flag, g, h in (("true", " + ng", " + nh"), ("false", "", ""))
    )
    candidates = f"""candidates_{r}_{d} AS MATERIALIZED (
      SELECT *, tg - lg AS rg, th - lh AS rh, CASE WHEN bin >= 0 AND lh >= 1 AND th - lh >= 1 THEN
        0.5 * (lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1)) END AS gain
      FROM ({sides}))"""
    best = f"""best_{r}_{d} AS MATERIALIZED (
      SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY node ORDER BY round(gain, 9) DESC, feature, bin, default_left DESC) AS place
        FROM candidates_{r}_{d} WHERE gain > 1e-6) WHERE place = 1)"""
    return [derived, f"hist_{r}_{d} AS MATERIALIZED ({lines})", sums, candidates, best]


def _route(r: int, d: int, size: int) -> str:
    bins = ", ".join(f"b{i}" for i in range(size))
    value = "CASE s.feature " + " ".join(f"WHEN {i} THEN b{i}" for i in range(size)) + " END"
    return f"""routed_{r}_{d} AS MATERIALIZED (
      SELECT k, y, m, {bins}, CASE WHEN s.node IS NULL THEN a.node
        WHEN ({value}) = -1 THEN 2 * a.node + (NOT s.default_left)::INT
        ELSE 2 * a.node + (({value}) > s.bin)::INT END AS node
      FROM derived_{r}_{d} a LEFT JOIN best_{r}_{d} s ON a.node = s.node)"""


def first_round_sql(cuts: list[list[float]]) -> str:
    """CTEs up to ``candidates_1_0`` and ``best_1_0``."""
    return ", ".join([_binned(cuts), *_level(1, 0, len(cuts))])


def boosted_sql(cuts: list[list[float]], rounds: int, depth: int, eta: float = 0.3) -> str:
    """CTEs up to ``state_<rounds + 1>`` (``k, m``: the margin of class 1) and ``trees``."""
    size = len(cuts)
    bins = ", ".join(f"b{i}" for i in range(size))
    parts, splits = [_binned(cuts)], []
    for r in range(1, rounds + 1):
        weights = []
        for d in range(depth):
            parts += [*_level(r, d, size), _route(r, d, size)]
            splits.append(
                f"SELECT {r - 1} AS round, node, feature, bin, default_left, gain FROM best_{r}_{d}"
            )
            weights += [
                f"SELECT 2 * node AS node, -{eta} * lg / (lh + 1) AS w FROM best_{r}_{d}",
                f"SELECT 2 * node + 1, -{eta} * rg / (rh + 1) FROM best_{r}_{d}",
            ]
        parts.append(f"weights_{r} AS MATERIALIZED ({' UNION ALL '.join(weights)})")
        parts.append(
            f"""state_{r + 1} AS MATERIALIZED (SELECT k, y, {bins}, m + w AS m
              FROM routed_{r}_{depth - 1} a JOIN weights_{r} b ON a.node = b.node)"""
        )
    parts.append(f"trees AS ({' UNION ALL '.join(splits)})")
    return ", ".join(parts)
