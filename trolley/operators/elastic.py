"""Sparse linear item-item model: one elastic-net fit per item from the Gram matrix.

For item j it minimises  1/(2n) ||x_j - X w||^2 + a*l1*|w|_1 + a*(1-l1)/2 ||w||^2  with
w_j = 0 (and w >= 0 if ``positive``). Only G = X'X is needed, and the optimum is unique for
l1 < 1, so the coordinate order does not matter.

Scale: G is built from (user block x item block) tiles, each a bounded dense product, so a
user with a huge profile is split over item blocks and no pairs of a profile are emitted.
Each item is solved on a working set of its strongest partners; the optimality conditions
are then checked against *all* partners in one sparse product, and violators join the
working set until none is left. The answer equals the full solve.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from trolley.session import materialise

# Pairs of a tile up to which they are formed one by one; beyond, the tile is one dense product.
SPARSE_PAIRS = 4_000_000
# Entries of a tile that are ranked at once.
STRIP = 1 << 21


def _tile_product(pdf: pd.DataFrame, strongest: int | None = None) -> pd.DataFrame:
    """X_lo' X_hi of one user block and one pair of item blocks; of each column the diagonal and the
    ``strongest`` other entries, if given."""
    lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
    sides = [pdf.loc[pdf["block"] == b, ["user", "item", "value"]] for b in (lo, hi)]
    meetings = (sides[0].groupby("user").size() * sides[1].groupby("user").size()).sum()
    if meetings <= SPARSE_PAIRS:  # short profiles: only the pairs that occur
        both = sides[0].merge(sides[1], on="user")
        both = both.assign(g=both["value_x"] * both["value_y"]).groupby(["item_x", "item_y"], sort=False)["g"].sum().reset_index()
        out = both.set_axis(["i", "j", "g"], axis=1)
        out = out[out["g"] != 0]
        out = out if lo == hi else pd.concat([out, out.rename(columns={"i": "j", "j": "i"})[["i", "j", "g"]]], ignore_index=True)
        if strongest is None:
            return out
        off = out[out["i"] != out["j"]].sort_values(["j", "g", "i"], ascending=[True, False, True]).groupby("j").head(strongest)
        return pd.concat([out[out["i"] == out["j"]], off], ignore_index=True)
    users, n_users = pdf["user"].factorize()[0], pdf["user"].nunique()

    def dense(block: int) -> tuple[np.ndarray, np.ndarray]:
        rows = (pdf["block"] == block).to_numpy()
        codes, names = pdf.loc[rows, "item"].factorize(sort=strongest is not None)
        x = np.zeros((n_users, len(names)))
        np.add.at(x, (users[rows], codes), pdf.loc[rows, "value"].to_numpy())
        return x, np.asarray(names)

    left, left_names = dense(lo)
    right, right_names = (left, left_names) if lo == hi else dense(hi)
    if strongest is not None:
        parts = [_strongest(left, left_names, right, right_names, strongest, lo == hi)]
        if lo != hi:
            parts.append(_strongest(right, right_names, left, left_names, strongest, False))
        return pd.concat(parts, ignore_index=True)
    product = left.T @ right
    i, j = np.nonzero(product)
    out = pd.DataFrame({"i": left_names[i], "j": right_names[j], "g": product[i, j]})
    if lo == hi:
        return out
    return pd.concat([out, out.rename(columns={"i": "j", "j": "i"})[["i", "j", "g"]]], ignore_index=True)


def _strongest(left: np.ndarray, left_names: np.ndarray, right: np.ndarray, right_names: np.ndarray, most: int, same: bool) -> pd.DataFrame:
    """Of each column of X_left' X_right the ``most`` largest entries (equal ones by the smaller item) and, if both
    sides are the ``same``, the diagonal; some columns at a time. The left names are sorted."""
    parts, step = [], max(1, STRIP // left.shape[1])
    for at in range(0, right.shape[1], step):
        product = right[:, at:at + step].T @ left  # a row per column j
        if same:
            own = np.arange(len(product))
            diagonal = product[own, at + own]
            product[own, at + own] = 0
            met = np.flatnonzero(diagonal)
            parts.append(pd.DataFrame({"i": left_names[at + met], "j": right_names[at + met], "g": diagonal[met]}))
        product[product == 0] = -np.inf
        least = np.partition(product, -most, axis=1)[:, -most][:, None] if most < product.shape[1] else -np.inf
        j, i = np.nonzero((product >= least) & (product > -np.inf))
        g = product[j, i]
        order = np.lexsort((i, -g, j))
        j, i, g = j[order], i[order], g[order]
        place = np.arange(len(j)) - np.searchsorted(j, j)
        kept = place < most
        parts.append(pd.DataFrame({"i": left_names[i[kept]], "j": right_names[at + j[kept]], "g": g[kept]}))
    return pd.concat(parts, ignore_index=True)


def gram(urm: DataFrame, users_per_block: int = 2048, items_per_block: int | None = None, strongest: int | None = None) -> DataFrame:
    """Non-zero entries ``(i, j, g)`` of X'X for triples (user, item, value).

    With ``strongest`` a caller that ranks each item's partners gets fewer of them: the diagonal and at least the
    ``strongest`` largest other entries of each column j (equal ones by the smaller i). If one block holds all
    users, the others never leave their tile; else they are cut after the tiles are added up.
    """
    # Bounds a tile by its cells, not by rows; stored, because it is read more than once.
    urm = materialise(urm.filter(F.col("user").isNotNull() & F.col("item").isNotNull()).groupBy("user", "item").agg(F.sum("value").cast("double").alias("value")), "cells")
    size = urm.agg(F.approx_count_distinct("user").alias("u"), F.approx_count_distinct("item").alias("i")).first()
    user_blocks = max(1, math.ceil(size["u"] / users_per_block))
    item_blocks = max(1, math.ceil(size["i"] / (items_per_block or (1024 if strongest is None else 4096))))
    kind = urm.schema["item"].dataType.simpleString()
    block_of = F.pmod(F.xxhash64("item"), F.lit(item_blocks)).cast("int")
    blocked = urm.select("user", "item", "value", F.pmod(F.xxhash64("user"), F.lit(user_blocks)).cast("int").alias("ub"), block_of.alias("block"))
    if item_blocks == 1:
        paired = blocked.withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    else:
        # A cell meets only the item blocks its own user has items in.
        has = blocked.groupBy("user").agg(F.collect_set("block").alias("others"))
        paired = (blocked.join(has, "user").withColumn("other", F.explode("others"))
                  .select("user", "item", "value", "ub", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    within = strongest if user_blocks == 1 else None
    if within is not None:  # few rows, much work: as many tasks as the session has for a shuffle
        wanted = min(item_blocks * (item_blocks + 1) // 2, int(urm.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        paired = paired.repartition(wanted, "ub", "lo", "hi")
    tiles = paired.groupBy("ub", "lo", "hi").applyInPandas(lambda pdf: _tile_product(pdf, within), f"i {kind}, j {kind}, g double")
    if within is not None:
        return tiles
    summed = tiles.groupBy("i", "j").agg(F.sum("g").alias("g"))
    if strongest is None:
        return summed
    best = W.partitionBy("j", F.col("i") == F.col("j")).orderBy(F.desc("g"), F.asc("i"))
    return summed.filter("g <> 0").withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= strongest).drop("_rn")


def _descend(g: np.ndarray, c: np.ndarray, n: float, l1: float, l2: float, positive: bool,
             sweeps: int, tol: float) -> tuple[np.ndarray, bool, int]:
    """Cyclic coordinate descent on a small Gram block."""
    w = np.zeros(len(c))
    gw = np.zeros(len(c))
    scale = np.diag(g) / n + l2
    for sweep in range(1, sweeps + 1):
        largest = 0.0
        for k in range(len(c)):
            if scale[k] <= 0:
                continue
            rho = (c[k] - gw[k] + g[k, k] * w[k]) / n
            new = max(rho - l1, 0.0) if positive else math.copysign(max(abs(rho) - l1, 0.0), rho)
            new /= scale[k]
            if new != w[k]:
                gw += g[:, k] * (new - w[k])
                largest = max(largest, abs(new - w[k]))
                w[k] = new
        if largest <= tol * max(1.0, np.abs(w).max(initial=0.0)):
            return w, True, sweep
    return w, False, sweeps


def _solve_target(pdf: pd.DataFrame, n: float, l1: float, l2: float, positive: bool, sweeps: int,
                  tol: float) -> pd.DataFrame:
    """Fit one target from its working set: rows (target, a, b, g, c) with c on the diagonal."""
    diagonal = pdf[pdf["a"] == pdf["b"]].sort_values("a")
    items = diagonal["a"].to_numpy()
    place = {item: k for k, item in enumerate(items)}
    g = np.zeros((len(items), len(items)))
    a, b = pdf["a"].map(place).to_numpy(), pdf["b"].map(place).to_numpy()
    g[a, b] = pdf["g"].to_numpy()
    g[b, a] = pdf["g"].to_numpy()
    w, converged, used = _descend(g, diagonal["c"].to_numpy(), n, l1, l2, positive, sweeps, tol)
    kept = np.flatnonzero(w)
    target = pdf["target"].iloc[0]
    out = pd.DataFrame({"target": target, "item": items[kept], "weight": w[kept], "converged": converged, "sweeps": used})
    status = pd.DataFrame({"target": [target], "item": [None], "weight": [np.nan], "converged": [converged], "sweeps": [used]})
    return pd.concat([out.astype({"item": object}), status.astype({"item": object})], ignore_index=True)


def slim_fit(urm: DataFrame, alpha: float = 1.0, l1_ratio: float = 0.1, positive: bool = True,
             topk: int | None = None, compat_topk: bool = False, width: int = 256, sweeps: int = 2000,
             tol: float = 1e-10, check_tol: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """(weights ``item_from, item_to, weight``; status ``item, converged, sweeps`` per target).

    ``topk`` keeps the largest weights into each item; ``compat_topk`` keeps one fewer than
    the non-zeros where there are not more than ``topk`` of them. ``width`` is only the size
    by which working sets grow.
    """
    n = float(urm.select("user").distinct().count())
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
    g = materialise(gram(urm), "gram")
    kind = urm.schema["item"].dataType.simpleString()
    strength = F.col("c") if positive else F.abs("c")
    partners = g.filter(F.col("i") != F.col("j")).select(F.col("j").alias("target"), F.col("i").alias("item"), F.col("g").alias("c"))
    strongest = W.partitionBy("target").orderBy(F.desc(strength), F.asc("item"))

    def widest(candidates: DataFrame, order) -> DataFrame:
        return (candidates.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= width)
                .select("target", "item", "c"))

    working = materialise(widest(partners.filter(strength > n * l1), strongest), "working")

    def solve(block: pd.DataFrame) -> pd.DataFrame:
        return _solve_target(block, n, l1, l2, positive, sweeps, tol)

    schema = f"target {kind}, item {kind}, weight double, converged boolean, sweeps int"
    finished = None  # solutions of targets whose working set has stopped growing
    while True:  # working sets grow strictly, so this ends
        first = working.select("target", F.col("item").alias("a"), "c")
        second = working.select("target", F.col("item").alias("b"))
        blocks = (first.join(second, "target").filter(F.col("a") <= F.col("b"))
                  .join(g.select(F.col("i").alias("a"), F.col("j").alias("b"), "g"), ["a", "b"], "left")
                  .select("target", "a", "b", F.coalesce("g", F.lit(0.0)).alias("g"), "c"))
        solved = materialise(blocks.groupBy("target").applyInPandas(solve, schema), "solved")
        weights = solved.filter(F.col("item").isNotNull())
        fitted = (weights.select("target", F.col("item").alias("j"), "weight").join(g, "j")
                  .groupBy("target", F.col("i").alias("item")).agg(F.sum(F.col("g") * F.col("weight")).alias("gw")))
        slack = (F.coalesce("c", F.lit(0.0)) - F.coalesce("gw", F.lit(0.0))) / n
        broken = (partners.join(fitted.filter(F.col("item") != F.col("target")), ["target", "item"], "full")
                  .select("target", "item", F.coalesce("c", F.lit(0.0)).alias("c"),
                          (slack if positive else F.abs(slack)).alias("_slack"))
                  .filter(F.col("_slack") > l1 + check_tol)
                  .join(working, ["target", "item"], "left_anti"))
        worst = W.partitionBy("target").orderBy(F.desc("_slack"), F.asc("item"))
        added = materialise(widest(broken, worst), "violators")
        growing = added.select("target").distinct()
        done = solved.join(growing, "target", "left_anti")
        finished = materialise(done if finished is None else finished.unionByName(done), "finished")
        if added.isEmpty():
            break
        # Only targets with new violators are solved again.
        working = materialise(working.unionByName(added).join(growing, "target", "left_semi"), "working")
        partners = materialise(partners.join(growing, "target", "left_semi"), "partners")

    solved = finished
    kept = solved.filter(F.col("item").isNotNull()).select(F.col("item").alias("item_from"), F.col("target").alias("item_to"), "weight")
    if topk is not None or compat_topk:
        ranked = kept.withColumn("_rn", F.row_number().over(W.partitionBy("item_to").orderBy(F.desc("weight"), F.asc("item_from"))))
        if compat_topk:
            counts = kept.groupBy("item_to").agg((F.count(F.lit(1)) - 1).alias("_most"))
            ranked = ranked.join(counts, "item_to").filter(F.col("_rn") <= F.col("_most"))
        if topk is not None:
            ranked = ranked.filter(F.col("_rn") <= topk)
        kept = ranked.select("item_from", "item_to", "weight")
    items = urm.select("item").distinct()
    status = (items.join(solved.filter(F.col("item").isNull()).select(F.col("target").alias("item"), "converged", "sweeps"), "item", "left")
              .select("item", F.coalesce("converged", F.lit(True)).alias("converged"), F.coalesce("sweeps", F.lit(0)).alias("sweeps")))
    return kept, status


def kkt_residuals(urm: DataFrame, weights: DataFrame, alpha: float = 1.0, l1_ratio: float = 0.1) -> DataFrame:
    """Optimality of a non-negative fit: per target, the largest gradient violation.

    With r = (G_kj - (Gw)_k)/n - a*l1 - a*(1-l1)*w_k:  r <= 0 where w_k = 0, r = 0 where w_k > 0.
    """
    n = float(urm.select("user").distinct().count())
    g = materialise(gram(urm), "gram")
    fitted = (weights.join(g, weights["item_from"] == g["j"])
              .groupBy(F.col("item_to").alias("target"), F.col("i").alias("item"))
              .agg(F.sum(F.col("g") * F.col("weight")).alias("gw")))
    target = g.select(F.col("j").alias("target"), F.col("i").alias("item"), "g")
    own = weights.select(F.col("item_to").alias("target"), F.col("item_from").alias("item"), "weight")
    zero = F.lit(0.0)
    table = (target.join(fitted, ["target", "item"], "full").join(own, ["target", "item"], "left")
             .filter(F.col("target") != F.col("item"))
             .select("target", "item", F.coalesce("weight", zero).alias("weight"),
                     ((F.coalesce("g", zero) - F.coalesce("gw", zero)) / n).alias("_rho")))
    r = F.col("_rho") - alpha * l1_ratio - alpha * (1 - l1_ratio) * F.col("weight")
    return table.groupBy("target").agg(F.max(F.when(F.col("weight") > 0, F.abs(r)).otherwise(F.greatest(r, zero))).alias("violation"))
