"""Properties checked against brute-force replays in plain Python on small
random inputs: upsert = sequential last-wins replay, quota cascade = the
sequential greedy scan, sampler = k distinct items per key, dense keys =
1..N in order."""

import random

import pytest
from pyspark.sql import functions as F

from cinelake import fixed_values
from cinelake.operators import keys, sampling, upsert


def _replay_upsert(base, batch):
    table = {k: v for k, v in base}
    for k, v, _pos in sorted(batch, key=lambda r: r[2]):
        table[k] = v
    return sorted(table.items())


@pytest.mark.parametrize("seed", range(4))
def test_upsert_equals_sequential_replay(spark, seed):
    rng = random.Random(seed)
    base = [(k, f"b{k}") for k in rng.sample(range(30), 12)]
    batch = [(rng.randrange(30), f"n{i}", p) for i, p in enumerate(rng.sample(range(1000), 25))]
    b = spark.createDataFrame(base, "k int, v string")
    n = spark.createDataFrame(batch, "k int, v string, pos int")
    got = sorted(tuple(r) for r in upsert.upsert(b, n, "k", "pos").collect())
    assert got == _replay_upsert(base, batch)


def _greedy(cands, targets, quota):
    seen, counts, out = set(), {t: 0 for t in targets}, []
    for cid, text, pos in sorted(cands, key=lambda r: r[2]):
        if cid in seen:
            continue
        for t in targets:
            if t in text and counts[t] < quota:
                out.append((cid, t))
                seen.add(cid)
                counts[t] += 1
                break
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_quota_cascade_equals_greedy_scan(spark, seed):
    rng = random.Random(seed)
    words = ["Action", "Sci-Fi", "Comedy", "Drama"]
    ids = [f"t{i}" for i in range(12)]
    texts = {i: ", ".join(rng.sample(words, rng.randint(0, 3))) for i in ids}
    positions = rng.sample(range(500), 39)
    cands = [(cid := rng.choice(ids), texts[cid], p) for p in positions]
    df = spark.createDataFrame(cands, "id string, genre string, pos int")
    targets = ["Action", "Sci-Fi", "Comedy"]
    got = sorted((r.id, r.target) for r in sampling.quota_select(df, targets, 2).collect())
    assert got == _greedy(cands, targets, 2)


@pytest.mark.parametrize("n_items,k", [(7, 5), (3, 5), (1, 5), (50, 5), (0, 5)])
def test_sampler_gives_min_k_n_distinct(spark, n_items, k):
    users = spark.createDataFrame([(u,) for u in range(1, 21)], "user_id int")
    items = spark.createDataFrame([(f"m{i}",) for i in range(n_items)], "movie_id string")
    rows = sampling.sample_k(users, items, "user_id", "movie_id", k=k).collect()
    per_user = {}
    for r in rows:
        per_user.setdefault(r.user_id, []).append(r.movie_id)
    if n_items == 0:
        assert rows == []
        return
    assert set(per_user) == set(range(1, 21))
    for picks in per_user.values():
        assert len(picks) == min(k, n_items) == len(set(picks))
    again = sorted(tuple(r) for r in sampling.sample_k(users, items, "user_id", "movie_id", k=k).collect())
    assert again == sorted(tuple(r) for r in rows)


def test_seeded_values_in_domain(spark):
    users = spark.createDataFrame([(u,) for u in range(1, 200)], "user_id int")
    cats = sampling.assign_categories(users, "user_id").collect()
    assert {r.age_group for r in cats} <= set(fixed_values.AGE_GROUPS)
    assert {r.country for r in cats} <= set(fixed_values.COUNTRIES)
    pairs = users.select("user_id", F.lit("m").alias("movie_id"))
    scores = sampling.synthetic_scores(pairs, ["user_id", "movie_id"]).collect()
    assert all(1 <= float(r.score) <= 10 and float(r.score) * 10 == int(float(r.score) * 10) for r in scores)
    assert {str(r.rated_at) for r in scores} == {sampling.RATED_AT}


def test_dense_index_is_one_to_n_in_order(spark):
    rng = random.Random(7)
    vals = rng.sample(range(100000), 3000)
    df = spark.createDataFrame([(v,) for v in vals], "v int").repartition(7)
    rows = keys.dense_index(df, [F.col("v")], name="id").collect()
    got = sorted((r.id, r.v) for r in rows)
    assert got == list(enumerate(sorted(vals), start=1))
