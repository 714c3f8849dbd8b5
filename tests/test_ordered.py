"""Order-dependent operators under one hot key, NULL keys and ties, against plain pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins as j, ordered
from tidemark.operators.models import infer_granularity
from tidemark.operators.ordered import batch_slice, number_rows, previous_value, running_sum


@pytest.fixture(autouse=True, params=["many blocks", "sized blocks"])
def blocks(request, spark):
    """Small ranges are normally joined into one block; half of the runs keep them apart."""
    if "skewed" not in request.fixturenames and request.param == "sized blocks":
        pytest.skip("once is enough")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(request.param == "sized blocks").lower())
    yield request.param
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows share key 0, some keys are NULL, and order values repeat."""
    rng = np.random.default_rng(1)
    n = 3000
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n)).astype(object)
    key[rng.random(n) < 0.05] = None
    return pd.DataFrame({"k": pd.array(key, "Int64"), "at": rng.integers(0, 500, n), "v": rng.integers(0, 9, n), "id": np.arange(n)})


def _df(spark, pdf):
    rows = [tuple(None if pd.isna(x) else int(x) for x in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "k long, at long, v long, id long")


def test_number_rows(spark, skewed):
    got = number_rows(_df(spark, skewed), [F.desc("v"), F.asc("id")], "n").select("id", "n").toPandas()
    want = skewed.sort_values(["v", "id"], ascending=[False, True])["id"].tolist()
    assert got.sort_values("n")["id"].tolist() == want
    assert sorted(got["n"]) == list(range(1, len(skewed) + 1))


def test_running_sum(spark, skewed):
    got = running_sum(_df(spark, skewed), ["k"], ["at"], {"v": "total"}).toPandas()
    peers = skewed.groupby(["k", "at"], dropna=False)["v"].sum().reset_index().sort_values(["k", "at"])
    peers["total"] = peers.groupby("k", dropna=False)["v"].cumsum()
    clean = lambda p: sorted((-1 if pd.isna(r.k) else int(r.k), int(r.at), int(r.total)) for r in p.itertuples())
    assert clean(got) == clean(peers)


def test_next_value_comes_from_the_same_blocks(spark, skewed):
    got = running_sum(_df(spark, skewed), ["k"], ["at"], {"v": "total"}, "next_at").toPandas()
    peers = skewed.groupby(["k", "at"], dropna=False)["v"].sum().reset_index().sort_values(["k", "at"])
    peers["next_at"] = peers.groupby("k", dropna=False)["at"].shift(-1)
    clean = lambda p: sorted((-1 if pd.isna(r.k) else int(r.k), int(r.at), -1 if pd.isna(r.next_at) else int(r.next_at)) for r in p.itertuples())
    assert clean(got) == clean(peers)


def test_running_sum_spans_blocks(spark, skewed, blocks):
    """The hot key really lies in several blocks, so the carried offsets are used."""
    hot = _df(spark, skewed).filter("k = 0")
    if blocks == "many blocks":
        cut = ordered._blocks(hot, [F.col("k"), F.col("at")], "test")
        assert cut.select(ordered._BLOCK).distinct().count() > 1
    got = running_sum(hot, ["k"], ["at"], {"v": "total"}).toPandas()
    assert got["total"].max() == skewed[skewed["k"] == 0]["v"].sum()


def test_previous_value(spark, skewed):
    got = previous_value(_df(spark, skewed).select("k", "at").distinct(), ["k"], "at", "prev").toPandas()
    want = skewed[["k", "at"]].drop_duplicates().sort_values(["k", "at"])
    want["prev"] = want.groupby("k", dropna=False)["at"].shift()
    clean = lambda p: sorted((-1 if pd.isna(r.k) else int(r.k), int(r.at), -1 if pd.isna(r.prev) else int(r.prev)) for r in p.itertuples())
    assert clean(got) == clean(want)


def test_batch_slice(spark, skewed):
    got = batch_slice(_df(spark, skewed), [F.asc("at"), F.asc("id")], 11, 20).orderBy("row_number").toPandas()
    assert got["id"].tolist() == skewed.sort_values(["at", "id"])["id"].tolist()[10:20]
    assert got["row_number"].tolist() == list(range(11, 21))


def test_interval_operators_agree(spark):
    rng = np.random.default_rng(2)
    lo = rng.integers(0, 300, 200)
    spans = pd.DataFrame({"id": np.arange(200), "g": rng.integers(0, 3, 200), "lo": lo, "hi": lo + rng.integers(0, 40, 200), "w": rng.integers(1, 9, 200)})
    points = rng.integers(0, 340, 300)
    s = spark.createDataFrame([tuple(int(x) for x in r) for r in spans.itertuples(index=False)], "id long, g long, lo long, hi long, w long")
    p = spark.createDataFrame([(int(x),) for x in points], "p long")

    load = {(r.g, r.point): (int(r.total), r.active) for r in j.interval_load(s, ["g"], "lo", "hi", "w").collect()}
    want = {}
    for r in spans.itertuples():
        for m in range(r.lo, r.hi + 1):
            a = want.get((r.g, m), (0, 0))
            want[(r.g, m)] = (a[0] + r.w, a[1] + 1)
    assert load == want

    counts = {r.id: r.points for r in j.count_in_intervals(s, "id", "lo", "hi", p, "p").collect()}
    brute = {r.id: int(((points >= r.lo) & (points <= r.hi)).sum()) for r in spans.itertuples()}
    assert counts == brute

    pairs = j.interval_join(s, "lo", "hi", p, "p", 25).count()
    assert pairs == sum(brute.values())


@pytest.mark.parametrize("max_km,cell", [(150, 1.0), (700, 2.0), (60, 0.5)])
def test_nearest_equals_brute_force(spark, max_km, cell):
    """Also across the date line and near a pole."""
    rng = np.random.default_rng(3)
    lat = np.concatenate([rng.uniform(-60, 60, 120), rng.uniform(86, 90, 40), rng.uniform(-5, 5, 40)])
    lon = np.concatenate([rng.uniform(-180, 180, 160), rng.choice([-179.9, 179.9, 179.5], 40)])
    rlat, rlon = np.concatenate([rng.uniform(-60, 90, 150), [0.0, 89.0]]), np.concatenate([rng.uniform(-180, 180, 150), [-179.8, 10.0]])
    left = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))], "id long, lat double, lon double")
    right = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rlat, rlon))], "key long, lat double, lon double")
    got = {r.id: r.key for r in j.nearest(left, right, "key", "lat", "lon", max_km, cell).collect()}

    def gap(a, b):
        h = np.sin(np.radians(rlat - a) / 2) ** 2 + np.cos(np.radians(a)) * np.cos(np.radians(rlat)) * np.sin(np.radians(rlon - b) / 2) ** 2
        return 2 * 6371010.0 * np.arcsin(np.minimum(1, np.sqrt(h)))

    want = {}
    for i, (a, b) in enumerate(zip(lat, lon)):
        d = gap(a, b)
        if d.min() <= max_km * 1000:
            want[i] = int(d.argmin())
    assert got == want and want


def test_granularity(spark):
    rows = [(f"2024-01-01 00:{m:02d}:00",) for m in range(0, 60, 5)] + [("2024-01-01 02:00:00",)]
    df = spark.createDataFrame(rows, "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    r = infer_granularity(df, "ts").first()
    assert (r.gap_seconds, r.gaps, round(r.confidence, 4)) == (300, 12, round(11 / 12, 4))


@pytest.mark.parametrize("values", [[1, 2], [1, None], [None], []])
def test_not_in_has_sql_null_rules(spark, values):
    left = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(x,) for x in values], "v int")
    want = spark.sql("SELECT k FROM {a} WHERE k NOT IN (SELECT v FROM {b})", a=left, b=right).collect()
    key = lambda r: (r.k is None, r.k)
    assert sorted(j.not_in(left, "k", right, "v").collect(), key=key) == sorted(want, key=key)
