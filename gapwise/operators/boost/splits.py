"""Split search as DataFrame aggregation.

The rows are reduced to sums per (class, node, feature, bin), a table whose size depends on
the model's settings only. Derivatives are summed as fixed-point integers: the order of
additions then cannot change the result, so any partitioning grows the same trees, and a
child's sums are exactly its parent's less its sibling's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

MIN_GAIN = 1e-6
WHOLE = -1  # the feature under which each row is counted once, whatever entries it has


def fixed_point_scale(rows: int) -> float:
    """The largest power of two, up to 2^30, for which sums over ``rows`` derivatives fit 64 bits."""
    return 2.0 ** min(30, 62 - max(rows, 1).bit_length())


def fixed_point(text: str, scale: float) -> str:
    """SQL text for a derivative as an integer multiple of ``1 / scale``."""
    return f"CAST(RINT(({text}) * {scale!r}D) AS BIGINT)"


def gradient_histogram(rows: DataFrame) -> DataFrame:
    """Sums per ``class, node, feature, bin`` of rows ``class, node, g, h, positions, bins``.

    Only the entries that a row has are exploded, inside the map stage, and partly summed there, so
    at most classes x nodes x features x bins lines per task are shuffled. ``n`` counts rows.
    """
    return rows.sparkSession.sql(histogram_text("{rows}"), rows=rows)


def histogram_text(rows: str) -> str:
    """SQL text for the sums of ``rows``; statements of a level are composed, so that each is planned once."""
    return f"""
      SELECT class, node, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n
      FROM (SELECT class, node, if(positions IS NULL, i - 1, get(positions, i)) AS feature, bin, g, h
        FROM (SELECT class, node, g, h, positions, posexplode(bins) AS (i, bin) FROM {rows}) WHERE bin >= 0)
      GROUP BY class, node, feature, bin"""


def siblings_text(light: str, parents: str, heavy_child: str, reducers: int = 0) -> str:
    """SQL text for the sums of all children, of which only the ``light`` ones have been counted.

    ``heavy_child`` is SQL text over the lines of ``parents`` for the node whose sums are missing, null
    where a parent was not split. Lines that no row is left in are dropped.
    """
    return f"""
      SELECT class, node, feature, bin, sum(g) AS g, sum(h) AS h, sum(n) AS n FROM (
        SELECT {_hint(reducers)} * FROM (
          SELECT class, side.node, feature, bin, side.g, side.h, side.n FROM (
            SELECT class, feature, bin, explode(array(struct(node, g, h, n), struct(node ^ 1 AS node, -g AS g, -h AS h, -n AS n))) AS side FROM {light})
          UNION ALL
          SELECT class, {heavy_child} AS node, feature, bin, g, h, n FROM {parents} WHERE {heavy_child} IS NOT NULL))
      GROUP BY class, node, feature, bin HAVING sum(n) > 0"""


def _hint(reducers: int) -> str:
    """One partition where one reducer holds everything anyway: later groupings then need no shuffle."""
    return "/*+ COALESCE(1) */" if reducers == 1 else ""


def split_candidates(histogram: DataFrame, scale: float, reg_lambda: float, gamma: float, min_child_weight: float, reducers: int = 0) -> DataFrame:
    """Every split after a bin, with missing values sent left and sent right.

    Left holds bins up to ``bin``; the split after the last bin parts present from missing.
    ``gain`` is null where a side is too light, and for the line of the totals themselves.
    """
    text = candidates_text("{histogram}", scale, reg_lambda, gamma, min_child_weight, reducers)
    return histogram.sparkSession.sql(text, histogram=histogram)


def candidates_text(
    histogram: str,
    scale: float,
    reg_lambda: float,
    gamma: float,
    min_child_weight: float,
    reducers: int = 0,
    totals: dict[tuple[int, int], tuple[int, int, int]] | None = None,
) -> str:
    """SQL text for the candidates of a histogram.

    The bins of a (class, node, feature) are one array, whose running sums are taken over exact integers.
    What a feature lacks of its node's ``totals`` is missing there; they are one line for each class and node,
    looked up in the histogram if they are not given, and broadcast.
    """

    def quality(side: str) -> str:
        return f"{side}_g * {side}_g / ({side}_h + {float(reg_lambda)!r}D)"

    heavy = " AND ".join(f"{side}_h >= {float(min_child_weight)!r}D" for side in ("left", "right"))
    known = f"SELECT class, node, g AS sum_g, h AS sum_h, n FROM {histogram} WHERE feature = {WHOLE}"
    if totals:
        known = f"SELECT * FROM VALUES {', '.join(f'({k}, {n}, {g}L, {h}L, {c}L)' for (k, n), (g, h, c) in totals.items())} AS v(class, node, sum_g, sum_h, n)"
    kind = "array<struct<bin: int, g: bigint, h: bigint, n: bigint>>"
    return f"""
      WITH grouped AS (
        SELECT class, node, feature, array_sort(collect_list(struct(CAST(bin AS INT) AS bin, g, h, n))) AS bins,
          sum(g) AS present_g, sum(h) AS present_h, sum(n) AS present_n
        FROM (SELECT {_hint(reducers)} * FROM {histogram}) GROUP BY class, node, feature),
      lines AS (
        SELECT class, node, feature, present_g, present_h, present_n, inline(aggregate(
          bins, named_struct('g', 0L, 'h', 0L, 'n', 0L, 'upto', CAST(array() AS {kind})),
          (a, x) -> named_struct('g', a.g + x.g, 'h', a.h + x.h, 'n', a.n + x.n,
            'upto', array_append(a.upto, named_struct('bin', x.bin, 'g', a.g + x.g, 'h', a.h + x.h, 'n', a.n + x.n))),
          a -> a.upto)) AS (bin, run_g, run_h, run_n) FROM grouped),
      totals AS ({known}),
      sides AS (
        SELECT /*+ BROADCAST(t) */ l.class, l.node, feature, bin, t.sum_g AS all_g, t.sum_h AS all_h, t.n, inline(array(
          struct(true AS default_left, run_g + t.sum_g - present_g AS sum_g, run_h + t.sum_h - present_h AS sum_h, run_n + t.n - present_n AS left_n),
          struct(false AS default_left, run_g AS sum_g, run_h AS sum_h, run_n AS left_n)))
        FROM lines l JOIN totals t ON l.class = t.class AND l.node = t.node),
      weighed AS (
        SELECT *, sum_g / {scale!r}D AS left_g, sum_h / {scale!r}D AS left_h, (all_g - sum_g) / {scale!r}D AS right_g,
          (all_h - sum_h) / {scale!r}D AS right_h, all_g / {scale!r}D AS total_g, all_h / {scale!r}D AS total_h FROM sides)
      SELECT *, CASE WHEN feature <> {WHOLE} AND {heavy} THEN
        0.5D * ({quality('left')} + {quality('right')} - {quality('total')}) - {float(gamma)!r}D END AS gain FROM weighed"""


def best_splits(candidates: DataFrame) -> DataFrame:
    """One line per ``class, node``: its sums and rows, its best split and the left side's, null if none pays.

    The best one is kept on both sides of the shuffle. Equal gains (to 9 places) go to the lower
    feature, then the lower bin, then left.
    """
    return candidates.sparkSession.sql(best_text("{candidates}"), candidates=candidates)


def best_text(candidates: str) -> str:
    rank = f"if(gain > {MIN_GAIN!r}D, struct(round(gain, 9) AS gain, -feature AS f, -bin AS b, default_left), NULL)"
    return f"""
      SELECT class, node, all_g, all_h, n, split.* FROM (
        SELECT class, node, max(all_g) AS all_g, max(all_h) AS all_h, max(n) AS n,
          max_by(struct(feature, bin, default_left, gain, sum_g, sum_h, left_n), {rank}) AS split
        FROM {candidates} GROUP BY class, node)"""
