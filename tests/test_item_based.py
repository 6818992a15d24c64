"""Scores from similar items by groups of users, and nearest vectors whose floors rise while blocks meet."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinion_spark.operators import recommend as R
from opinion_spark.operators import similarity as M

PAIRS = "product_id long, other long, sim double"
RATINGS = "user_id long, product_id long, rating double"


def expected(ratings, pairs, n, min_sim=0.1):
    seen = {(u, i) for u, i, _ in ratings if u is not None}
    sums = {}
    for u, i, r in ratings:
        for p, o, s in pairs:
            if i is not None and p == i and o is not None and o != p and s > min_sim and (u, o) not in seen:
                ws, ss = sums.get((u, o), (None, 0.0))
                sums[u, o] = (ws if r is None else (ws or 0.0) + r * s, ss + s)
    out = set()
    for user in {u for u, _ in sums}:
        mine = [(o, ws if ws is None else ws / ss, min(ss, 1.0)) for (u, o), (ws, ss) in sums.items() if u == user]
        mine.sort(key=lambda x: (x[1] is None, -round(x[1] or 0.0, 9), x[0]))
        out |= {(user, o, v if v is None else round(v, 6), round(c, 6)) for o, v, c in mine[:n]}
    return out


@pytest.mark.parametrize("group_rows, rows_per_user", [(7, 4), (8000, 4), (8000, 2000)])
def test_groups_of_users_equal_the_plain_join(spark, group_rows, rows_per_user):
    rng = np.random.default_rng(2)
    pairs = [(i, int(o), round(float(s), 9)) for i in range(30) for o, s in zip(rng.integers(0, 36, 6), rng.random(6))]
    pairs += [(i, i, 1.0) for i in range(30)] + [pairs[0], (3, None, 0.9), (None, 3, 0.9)]  # the item itself, one twice, null ids
    rated = {(int(u), int(i)) for u, i in zip(rng.integers(0, 12, 90), rng.integers(0, 40, 90))}
    ratings = [(u, i, None if (u + i) % 5 == 0 else float(1 + (u * 7 + i) % 5)) for u, i in sorted(rated)]
    ratings += [(None, 3, 4.0), (None, 8, None), (2, None, 5.0), (50, 39, 5.0)]
    got = R.item_based(spark.createDataFrame(ratings, RATINGS), spark.createDataFrame(pairs, PAIRS), 4,
                       group_rows=group_rows, rows_per_user=rows_per_user).collect()
    rounded = [(r[0], r[1], r[2] if r[2] is None else round(r[2], 6), round(r[3], 6)) for r in got]
    assert len(set(rounded)) == len(rounded) and set(rounded) == expected(ratings, pairs, 4)


def test_ids_are_of_any_type(spark):
    ratings = spark.createDataFrame([("u", "a", 5.0), ("v", "b", 1.0)], "user_id string, product_id string, rating double")
    near = spark.createDataFrame([("a", "b", 0.5), ("b", "a", 0.5), ("b", "c", 0.2)], "product_id string, other string, sim double")
    got = {(r[0], r[1], r[2], r[3]) for r in R.item_based(ratings, near).collect()}
    assert got == {("u", "b", 5.0, 0.5), ("v", "a", 1.0, 0.5), ("v", "c", 1.0, 0.2)}


def test_ratings_are_worked_out_once_and_no_candidate_is_joined(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    ratings = spark.range(60).select(
        (F.col("id") % 6).alias("user_id"), F.col("id").alias("product_id"), F.lit(3.0).alias("rating")).mapInPandas(counted, RATINGS)
    near = spark.range(60).select(F.col("id").alias("product_id"), ((F.col("id") + 1) % 60).alias("other"), F.lit(0.5).alias("sim"))
    out = R.item_based(ratings, near, 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "LeftAnti" not in plan.split("FlatMapGroupsInArrow")[0]
    assert out.count() == 60 and read.value == 60


def parts(n, blocks, k, seed=0, width=8):
    v = np.random.default_rng(seed).normal(size=(2 * n, width))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    block = np.arange(2 * n) * blocks // n
    floor = np.empty(2 * n)
    for b in range(2 * blocks):
        own = v[block == b] @ v[block == b].T
        floor[block == b] = np.sort(own, axis=1)[:, -k]
    frame = pd.DataFrame({"id": np.arange(2 * n), "p": None, "v": list(v), "block": block.astype(str), "floor": floor})
    left = frame[:n].copy()
    left["mates"] = [[str(b) for b in range(blocks, 2 * blocks)]] * n
    return v, floor, M._Part(left, "id", None, k), M._Part(frame[n:], "id", None, k)


def test_floors_rise_while_blocks_meet(monkeypatch):
    n, blocks, k = 1200, 12, 5
    v, floor, left, right = parts(n, blocks, k)
    added, plain = [], M._Part.add
    monkeypatch.setattr(M._Part, "add", lambda self, name, rows, *more: added.append(len(rows)) or plain(self, name, rows, *more))
    for a, mates in left.mates.items():
        for b in mates:
            M._meet(left, a, right, b, True, cells=5000)
    sims = np.round(v[:n] @ v[n:].T, 9)
    for mine, theirs, s, low in ((left, right, sims, floor[:n]), (right, left, sims.T, floor[n:])):
        got = pd.concat(mine.told(theirs, "id"))
        assert (got.groupby("id").size() <= k).all()
        of, to = mine.ids[0], theirs.ids[0]
        found = set(zip(got["id"], got["other"]))
        want = {(of + i, to + int(j)) for i in range(n) for j in np.lexsort((np.arange(n), -s[i]))[:k] if s[i, j] >= low[i]}
        assert want <= found
    fixed = (sims >= floor[:n, None] - 2e-9).sum() + (sims >= floor[None, n:] - 2e-9).sum()
    assert sum(added) < 0.6 * fixed


@pytest.mark.parametrize("keep_self", [False, True])
def test_single_precision_loses_no_neighbour(spark, keep_self):
    """Similarities that differ by less than single precision tells, copies, repeated ids and a zero vector."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(8, 12))
    v = np.concatenate([base[rng.integers(0, 8, 240)] + rng.normal(size=(240, 12)) * 10.0 ** -rng.integers(3, 9, (240, 1)), base, base])
    v = np.concatenate([v, np.zeros((2, 12))])
    ids = np.concatenate([np.arange(256), [256, 40]])
    length = np.linalg.norm(v, axis=1, keepdims=True)
    unit = np.divide(v, length, out=np.zeros_like(v), where=length > 0)
    sims = np.round(unit @ unit.T, 9)
    want = {}
    for i in set(ids.tolist()):
        all_ = [(-sims[r, c], int(ids[c])) for r in np.flatnonzero(ids == i) for c in range(len(ids)) if keep_self or ids[c] != i]
        want[i] = [-s for s, _ in sorted(all_)[:6]]
    data = spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in zip(ids, v)], "id long, v array<double>")
    got = {}
    for r in M.dense_neighbours(data, "id", "v", 6, keep_self, per_block=20, per_pivot=30).collect():
        got.setdefault(r["id"], []).append(r["sim"])
    assert got.keys() == want.keys()
    assert max(np.abs(np.sort(got[i]) - np.sort(want[i])).max() for i in want) < 2e-9  # of rounded values
