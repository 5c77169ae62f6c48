from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from citylake.operators import incremental, joins, ordered, sampling, stats, totals
from citylake.operators.dedup import latest_version, latest_wins
from citylake.operators.fill import dense_forward_fill, densify, value_on, value_runs
from citylake.operators.scd2 import scd2_dimension, snapshot_check
from citylake.operators.spatial import cover, spatial_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to one key; values have gaps."""
    rng = random.Random(5)
    data = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        data.append((key, i, rng.random() if rng.random() < 0.4 else None, rng.randrange(3)))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, at int, v double, flag int").cache()


@pytest.fixture(scope="module")
def cut(skewed):
    return ordered.cut_long_groups(skewed, "k", "at", slices=12).cache()


def same(a, b, columns):
    left = sorted(map(tuple, a.select(*columns).collect()), key=repr)
    right = sorted(map(tuple, b.select(*columns).collect()), key=repr)
    return left == right


def test_hot_key_is_spread_over_slices(cut):
    sizes = cut.filter("k = 'hot'").groupBy(ordered.SLICE).count().collect()
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 300


def test_sliced_forward_fill_equals_plain(skewed, cut):
    plain = ordered.forward_fill(skewed, "k", "at", ["v"])
    assert same(plain, ordered.forward_fill(cut, "k", "at", ["v"], ordered.SLICE), ["k", "at", "v"])


def test_sliced_neighbours_equal_plain(skewed, cut):
    for step in (ordered.previous, ordered.following):
        plain = step(skewed, "k", "at", {"o": "at", "x": "v"})
        assert same(plain, step(cut, "k", "at", {"o": "at", "x": "v"}, ordered.SLICE), ["k", "at", "o", "x"])


def test_sliced_running_sum_equals_plain(skewed, cut):
    plain = ordered.running_sum(skewed, "k", "at", "flag", "s")
    assert same(plain, ordered.running_sum(cut, "k", "at", "flag", "s", ordered.SLICE), ["k", "at", "s"])


def test_sliced_rolling_mean_equals_plain(spark):
    data = [("hot", i, float(i % 17)) for i in range(9000)] + [("cold", i, float(i)) for i in range(10)]
    df = spark.createDataFrame(data, "k string, at int, v double")
    rolled = ordered.rolling_mean(ordered.cut_long_groups(df, "k", "at", 6), "k", "at", "v", 7, slices=ordered.SLICE)
    assert same(ordered.rolling_mean(df, "k", "at", "v", 7), rolled, ["k", "at", "v_rolling"])


def test_rolling_needs_a_full_window(spark, rows):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 5)], "k string, d int, bikes double")
    assert rows(ordered.rolling_mean(df, "k", "d", "bikes", 3), "d", "bikes_rolling") == [
        (1, None), (2, None), (3, 2.0), (4, 3.0)]


def test_gaps_with_and_without_slices(spark, rows):
    start = datetime(2026, 1, 1)
    hours = [h for h in range(200) if h not in (50, 51, 120)]
    df = spark.createDataFrame([("s", start + timedelta(hours=h)) for h in hours + hours[:5]], "k string, at timestamp")
    expected = [(start + timedelta(hours=49), start + timedelta(hours=52)), (start + timedelta(hours=119), start + timedelta(hours=121))]
    for found in (
        ordered.time_gaps(df, "at", ["k"]), ordered.time_gaps(df, "at", ["k"], slices=5), ordered.time_gaps(df, "at")
    ):
        assert rows(found, "ts", "next_ts") == expected


def test_latest_wins_is_deterministic_on_ties(spark, rows):
    data = [(k, 1, v) for k in range(5) for v in range(6)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, loaded int, v int").repartition(seed + 1)
        results.add(tuple(rows(latest_wins(df, "k", ["loaded"]))))
    assert len(results) == 1


def test_removed_record_stays_unlisted(spark, rows):
    days = [date(2026, 1, 1), date(2026, 1, 2)]
    df = spark.createDataFrame([("a", 1, days[0]), ("a", 2, days[1]), ("b", 3, days[0])], "id string, v int, load_date date")
    assert rows(latest_version(df, "id"), "id", "v", "first_seen_date", "last_listed_date", "is_listed") == [
        ("a", 2, days[0], days[1], True), ("b", 3, days[0], days[0], False)]


def test_dense_fill_repeats_the_last_day(spark, rows):
    df = spark.createDataFrame(
        [("EUR", date(2026, 1, 1), 24.0), ("EUR", date(2026, 1, 4), 25.0), ("USD", date(2026, 1, 2), 20.0)],
        "c string, d date, rate double")
    got = rows(dense_forward_fill(df, "c", "d"), "c", "d", "rate", "is_forward_filled")
    assert [(c, d.day, r, f) for c, d, r, f in got] == [
        ("EUR", 1, 24.0, False), ("EUR", 2, 24.0, True), ("EUR", 3, 24.0, True), ("EUR", 4, 25.0, False),
        ("USD", 1, None, True), ("USD", 2, 20.0, False), ("USD", 3, 20.0, True), ("USD", 4, 20.0, True)]


def test_not_in_follows_sql(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert rows(joins.not_in(left, "a", spark.createDataFrame([(2,)], "b int"), "b")) == [(1,)]
    assert rows(joins.not_in(left, "a", spark.createDataFrame([(2,), (None,)], "b int"), "b")) == []


def test_overlaps_are_found_behind_a_short_version(spark, rows):
    data = [("s", "a", 0, 10), ("s", "b", 1, 2), ("s", "c", 5, 6), ("s", "d", 10, 12), ("t", "e", 0, 5)]
    df = spark.createDataFrame(data, "k string, v string, f int, t int")
    for slices in (None, 3):
        found = joins.overlapping_versions(df, "k", "v", "f", "t", slices)
        assert rows(found) == [("s", "b", "a"), ("s", "c", "a")]


@pytest.mark.parametrize("by_month", [False, True])
def test_interval_join_finds_exactly_one_version(spark, rows, by_month):
    versions = spark.createDataFrame(
        [("s", "v1", datetime(1900, 1, 1), datetime(2026, 3, 10)), ("s", "v2", datetime(2026, 3, 10), datetime(9999, 12, 31))],
        "id string, version string, valid_from_ts_utc timestamp, valid_to_ts_utc timestamp")
    facts = spark.createDataFrame(
        [("s", datetime(2026, 1, 5)), ("s", datetime(2026, 3, 9, 23)), ("s", datetime(2026, 3, 10)), ("x", datetime(2026, 3, 10))],
        "id string, ts timestamp")
    got = rows(joins.interval_join(facts, versions, "id", "ts", by_month=by_month), "id", "ts", "version")
    assert [(i, v) for i, _, v in got] == [("s", "v1"), ("s", "v1"), ("s", "v2"), ("x", None)]


def test_long_versions_are_not_repeated_month_by_month(spark, rows):
    years = [(k, y, datetime(y, 1, 1), datetime(y + 2, 1, 1)) for k in range(3) for y in range(1980, 2020)]
    open_end = [(9, 0, datetime(1980, 1, 1), datetime(9999, 12, 31))]
    versions = spark.createDataFrame(years + open_end, "id long, version long, valid_from_ts_utc timestamp, valid_to_ts_utc timestamp")
    days = [(k, datetime(1985, 1, 1) + timedelta(days=97 * n)) for k in (0, 2, 9, None) for n in range(120)]
    facts = spark.createDataFrame([*days, (None, datetime(1700, 1, 1)), (1, None)], "id long, ts timestamp")
    left, right = joins.in_periods(facts, versions, "ts", "valid_from_ts_utc", "valid_to_ts_utc")
    assert left.count() == facts.count()
    covering = versions.filter("valid_to_ts_utc >= timestamp'1985-01-01' and valid_from_ts_utc < timestamp'2017-01-01'").count()
    assert covering <= right.count() <= 4 * covering
    for how in ("left", "inner"):
        plain = joins.interval_join(facts, versions, "id", "ts", how=how)
        assert rows(joins.interval_join(facts, versions, "id", "ts", how=how, by_month=True)) == rows(plain)


def test_a_join_by_month_without_versions_or_facts_in_range(spark):
    versions = spark.createDataFrame([(1, 7, datetime(2020, 1, 1), datetime(2020, 1, 2))], "id long, version long, valid_from_ts_utc timestamp, valid_to_ts_utc timestamp")
    facts = spark.createDataFrame([(1, datetime(2021, 1, 1))], "id long, ts timestamp")
    assert joins.interval_join(facts, versions, "id", "ts", by_month=True).select("version").first()[0] is None
    assert joins.interval_join(facts, versions.limit(0), "id", "ts", by_month=True).count() == 1
    assert joins.interval_join(facts.limit(0), versions, "id", "ts", by_month=True).count() == 0


def hot_versions(spark, overlap=False):
    """10,000 versions and half of all facts of one key, with gaps, missing keys and missing instants."""
    versions = spark.range(10_100).selectExpr(
        "if(id < 10000, 'hot', concat('k', id % 7)) as id", "concat('v', id) as version",
        "timestamp_seconds(id * 3600) as valid_from_ts_utc",
        f"timestamp_seconds(id * 3600 + if(id % 10 = 3, 1800, if(id % 10 = 5, {5400 if overlap else 3600}, 3600 * if(id < 10000, 1, 7)))) as valid_to_ts_utc")
    facts = spark.range(20_000).selectExpr(
        "id as n", "case when id % 2 = 0 then 'hot' when id % 97 = 1 then null else concat('k', id % 9) end as id",
        "if(id % 41 = 7, null, timestamp_seconds((id * 7919) % 36500000)) as ts", "'own' as _at")
    return facts, versions


def test_many_versions_meet_facts_in_linear_work(spark, monkeypatch):
    facts, versions = hot_versions(spark)
    steps = []
    cut = joins.cut_long_groups

    def counted(df, *args):
        made = cut(df, *args)
        if "_fact" in made.columns:
            steps.append((made.count(), made.groupBy("_slice").count().agg(F.max("count")).first()[0]))
        return made

    monkeypatch.setattr(joins, "cut_long_groups", counted)
    plain = facts.join(versions.withColumnRenamed("id", "key"), F.expr("id = key and ts >= valid_from_ts_utc and ts < valid_to_ts_utc"), "left").drop("key")
    for how in ("left", "inner"):
        want = plain if how == "left" else plain.where("version is not null")
        got = joins.interval_join(facts, versions, "id", "ts", how=how, slices=16)
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # One row per fact and version, in runs of even size: no fact was held against more than one version.
    assert {rows for rows, _ in steps} == {30_100} and all(largest < 3 * 30_100 / 16 for _, largest in steps)


def test_overlapping_versions_all_match(spark):
    facts, versions = hot_versions(spark, overlap=True)
    some = facts.where("n % 10 < 3")
    got = joins.interval_join(some, versions, "id", "ts")
    assert got.count() > some.count() and got.where("version is null").count() > 0
    assert joins.versions_overlap(versions, "id", "valid_from_ts_utc", "valid_to_ts_utc")


def test_spatial_join_equals_brute_force(spark):
    rng = random.Random(3)
    polygons = []
    for n in range(6):
        cx, cy = rng.uniform(0, 1), rng.uniform(0, 1)
        angles = sorted(rng.uniform(0, 6.283) for _ in range(9))
        ring = [[cx + rng.uniform(0.05, 0.3) * np.cos(a), cy + rng.uniform(0.05, 0.3) * np.sin(a)] for a in angles]
        ring.append(ring[0])
        polygons.append((f"p{n}", str({"type": "Polygon", "coordinates": [[[float(x), float(y)] for x, y in ring]]}).replace("'", '"')))
    points = [(i, rng.uniform(-0.2, 1.2), rng.uniform(-0.2, 1.2)) for i in range(400)]
    pts = spark.createDataFrame(points, "i int, longitude double, latitude double")
    polys = spark.createDataFrame(polygons, "name string, geometry_geojson string")
    from citylake.functions.geo import edges_contain, polygon_rings, ring_edges

    brute = pts.crossJoin(polys).filter(edges_contain(ring_edges(polygon_rings("geometry_geojson")), "longitude", "latitude"))
    expected = sorted(tuple(r) for r in brute.select("i", "name").collect())
    for cell in (0.03, 0.25, 2.0):
        got = spatial_join(pts, polys, cell=cell, how="inner").select("i", "name")
        assert sorted(tuple(r) for r in got.collect()) == expected
    left = spatial_join(pts, polys, cell=0.1)
    assert left.select("i").distinct().count() == 400


def ring_of(points):
    return str({"type": "Polygon", "coordinates": [[list(p) for p in points]]}).replace("'", '"')


def test_cells_follow_the_outline(spark):
    """A disc 1,000 cells wide with 4,000 corners, and a square with four."""
    angles = [2 * np.pi * i / 4000 for i in range(4000)]
    disc = ring_of([(float(5 + 5 * np.cos(a)), float(5 + 5 * np.sin(a))) for a in angles])
    square = ring_of([(0.001, 0.001), (9.999, 0.001), (9.999, 9.999), (0.001, 9.999)])
    polygons = spark.createDataFrame([(0, disc), (1, square)], "_polygon long, g string")
    cells = cover(polygons, "g", 0.01).selectExpr("_polygon", "level", "size(edges) as n").collect()
    of_disc = [c for c in cells if c["_polygon"] == 0]
    # The outline passes about 4,000 cells of this width; the area holds 785,000.
    assert len(of_disc) < 4000 and sum(c["n"] for c in of_disc) < 4 * 4000
    assert len([c for c in cells if c["_polygon"] == 1]) == 1
    rng = random.Random(6)
    points = [(i, rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(3000)] + [(9000 + i, 5 + 4.9999 * np.cos(i), 5 + 4.9999 * np.sin(i)) for i in range(300)]
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, x, y in points], "i int, longitude double, latitude double")
    got = {r["i"] for r in spatial_join(pts, spark.createDataFrame([(disc,)], "geometry_geojson string"), how="inner").select("i").collect()}
    sure = {i for i, x, y in points if np.hypot(x - 5, y - 5) < 4.99999}
    assert sure <= got and all(np.hypot(x - 5, y - 5) <= 5 for i, x, y in points if i in got)


@pytest.mark.parametrize(("turned", "few"), [(False, 8), (True, 8), (False, 1)])
def test_points_level_with_edges_and_corners(spark, monkeypatch, turned, few):
    """A lattice of points over squares, steps and slopes, so that most points share a height or a side with a corner."""
    monkeypatch.setattr("citylake.operators.spatial.FEW", few)
    rings = [
        [(1, 1), (4, 1), (4, 4), (1, 4)],
        [(5, 1), (9, 1), (9, 5), (8, 5), (8, 3), (7, 3), (7, 5), (5, 5)],
        [(2, 5), (5, 8), (2, 9), (1, 7)],
        [(6, 6), (9, 6), (9, 9), (7, 9), (7, 8), (6, 8)],
    ]
    polygons = [(f"p{i}", ring_of([(float(x), float(y)) for x, y in (ring[::-1] if turned else ring)])) for i, ring in enumerate(rings)]
    polys = spark.createDataFrame(polygons, "name string, geometry_geojson string")
    points = [(i * 100 + j, i / 4, j / 4) for i in range(44) for j in range(44)]
    pts = spark.createDataFrame(points, "i int, longitude double, latitude double").cache()
    from citylake.functions.geo import edges_contain, polygon_rings, ring_edges

    brute = pts.crossJoin(polys).filter(edges_contain(ring_edges(polygon_rings("geometry_geojson")), "longitude", "latitude"))
    expected = sorted(tuple(r) for r in brute.select("i", "name").collect())
    assert len(expected) > 300
    for cell in (0.3, 1.0, 2.0, 9.0):
        got = spatial_join(pts, polys, cell=cell, how="inner").select("i", "name")
        assert sorted(tuple(r) for r in got.collect()) == expected


def test_holes_corners_and_points_without_a_place(spark):
    outer, hole = [(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)]
    geometry = str({"type": "Polygon", "coordinates": [[list(map(float, p)) for p in ring] for ring in (outer, hole)]}).replace("'", '"')
    points = [(0, 0.5, 0.5), (1, 2.0, 2.0), (2, 0.0, 0.0), (3, 4.0, 2.0), (4, 1.0, 1.0), (5, 2.0, 1.0), (6, 3.5, 3.0), (7, None, 1.0), (8, 1.0, 3.5), (9, -1.0, 3.0)]
    pts = spark.createDataFrame(points, "i int, longitude double, latitude double")
    polygons = spark.createDataFrame([("a", geometry), ("none", None)], "name string, geometry_geojson string")
    for cell in (0.01, 0.3, 7.0):
        joined = spatial_join(pts, polygons, cell=cell)
        assert joined.columns == ["i", "longitude", "latitude", "name", "geometry_geojson"]
        assert sorted((r["i"], r["name"]) for r in joined.collect()) == [(i, "a" if i in (0, 6, 8) else None) for i in range(10)]


CHECKED = ["name", "listed"]


def run(spark, history, current, hour):
    df = spark.createDataFrame(current, "id string, name string, listed boolean")
    return snapshot_check(history, df, "id", CHECKED, datetime(2026, 1, 1, hour))


def test_snapshot_add_change_remove_return_noop(spark, rows):
    s = run(spark, None, [("a", "A", True), ("b", None, True)], 0)
    s = run(spark, s, [("a", "A", True), ("b", None, True)], 1)
    assert s.count() == 2
    s = run(spark, s, [("a", "A2", True), ("b", None, True), ("c", "C", True)], 2)
    s = run(spark, s, [("a", "A2", False), ("c", "C", True)], 3)
    s = run(spark, s, [("a", "A2", True), ("b", "B", True), ("c", "C", True)], 4)
    got = [(i, n, listed, f.hour, t and t.hour) for i, n, listed, f, t in rows(s, "id", "name", "listed", "scd_valid_from", "scd_valid_to")]
    assert sorted(got, key=repr) == sorted([
        ("a", "A", True, 0, 2), ("a", "A2", True, 2, 3), ("a", "A2", False, 3, 4), ("a", "A2", True, 4, None),
        ("b", None, True, 0, 4), ("b", "B", True, 4, None), ("c", "C", True, 2, None)], key=repr)


def test_dimension_merges_equal_rows_without_gaps(spark, rows):
    at = lambda h: datetime(2026, 1, 1, h)
    data = [("x1", "s", "A", at(1)), ("x2", "s", "A", at(2)), ("x3", "s", "B", at(3)), ("x4", "s", "A", at(4))]
    df = spark.createDataFrame(data, "scd_id string, id string, name string, scd_valid_from timestamp")
    got = rows(scd2_dimension(df, "id", ["name"]), "scd_id", "name", "valid_from_ts_utc", "valid_to_ts_utc", "is_current")
    open_end, beginning = datetime(9999, 12, 31), datetime(1900, 1, 1)
    assert got == [("x1", "A", beginning, at(3), False), ("x3", "B", at(3), at(4), False), ("x4", "A", at(4), open_end, True)]


def test_delete_insert_and_new_column(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B", 9), (3, "C", 9)], "k int, v string, extra int")
    assert rows(incremental.delete_insert(target, batch, "k")) == [(1, "a", None), (2, "B", 9), (3, "C", 9)]


def test_lookback_keeps_all_rows_without_a_target(spark):
    df = spark.range(5)
    assert incremental.lookback(df, "id", None, "id").count() == 5


def test_exact_sample_is_exact_and_stable(spark):
    df = spark.range(3000).withColumn("v", F.col("id") % 7)
    first = {r.id for r in sampling.exact_sample(df.repartition(3), 100).collect()}
    second = {r.id for r in sampling.exact_sample(df.repartition(7), 100).collect()}
    other = {r.id for r in sampling.exact_sample(df, 100, seed=1).collect()}
    assert len(first) == 100 and first == second and first != other
    assert sampling.exact_sample(df, 5000).count() == 3000


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_equal_numpy(spark, accuracy):
    rng = random.Random(1)
    values = [("hot", float(rng.randrange(900))) for _ in range(9000)] + [("cold", rng.random()) for _ in range(7)]
    df = spark.createDataFrame(values, "k string, v double")
    probabilities = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {(r.k, r.probability): r.quantile for r in stats.exact_quantiles(df, "v", probabilities, "k", accuracy).collect()}
    for key in ("hot", "cold"):
        expected = np.quantile([v for k, v in values if k == key], probabilities)
        assert [got[key, p] for p in probabilities] == pytest.approx(list(expected))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 11, 200])
def test_quantiles_of_small_groups(spark, n):
    rng = random.Random(n)
    values = [rng.choice([rng.random(), 0.5]) for _ in range(n)]
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.probability: r.quantile for r in stats.exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", probabilities).collect()}
    assert [got[p] for p in probabilities] == pytest.approx(list(np.quantile(values, probabilities)))


def test_gaps_of_a_key_with_most_rows(spark):
    df = spark.range(20_000).selectExpr("if(id % 10 < 9, 'hot', concat('k', id % 50)) as k", "timestamp_seconds(id * 3600 + if(id % 1000 = 999, 7200, 0)) as at")
    cut = {tuple(r) for r in ordered.time_gaps(df, "at", ["k"]).collect()}
    whole = {tuple(r) for r in ordered.time_gaps(df, "at", ["k"], bounded=True).collect()}
    assert cut == whole and any(r[0] == "hot" for r in cut)


def test_sample_of_few_distinct_rows(spark):
    df = spark.range(400).selectExpr("id % 3 as id", "if(id % 3 = 0, null, 'x') as v")
    assert sampling.exact_sample(df, 50).count() == 50
    assert sampling.exact_sample(df, 400).count() == 400
    assert sampling.exact_sample(df.limit(0), 5).count() == 0


def test_fill_of_a_period_takes_what_was_known_before(spark, rows):
    df = spark.createDataFrame(
        [("EUR", date(2026, 1, 1), 24.0), ("EUR", date(2026, 1, 9), None), ("EUR", date(2087, 1, 1), 9.0), ("USD", date(2026, 1, 11), 20.0), ("USD", None, 1.0)],
        "c string, d date, rate double")
    got = rows(dense_forward_fill(df, "c", "d", date(2026, 1, 8), date(2026, 1, 11)), "c", "d", "rate", "is_forward_filled")
    assert [(c, d.day, r, f) for c, d, r, f in got] == [
        ("EUR", 8, 24.0, True), ("EUR", 9, 24.0, False), ("EUR", 10, 24.0, True), ("EUR", 11, 24.0, True),
        ("USD", 8, None, True), ("USD", 9, None, True), ("USD", 10, None, True), ("USD", 11, 20.0, False)]
    sparse = rows(densify(df, "c", "d", date(2026, 1, 8), date(2026, 1, 9)), "c", "d", "rate", "is_forward_filled")
    assert [(c, d.day, r, f) for c, d, r, f in sparse] == [
        ("EUR", 8, None, True), ("EUR", 9, None, False), ("USD", 8, None, True), ("USD", 9, None, True)]
    assert value_runs(df, "c", "d").count() == 4, "one run per known row, whatever the days between"
    assert densify(df.limit(0), "c", "d").collect() == []


@pytest.mark.parametrize("known", [5, 300])
def test_days_meet_their_run(spark, known):
    rng = random.Random(known)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(700)]
    data = [(k, d, rng.random()) for k in ("a", "hot") for d in sorted(rng.sample(days[20:], known))]
    asked = [(i, rng.choice(["hot", "hot", "a", "none", None]), rng.choice([*days, None])) for i in range(2000)]
    runs = value_runs(spark.createDataFrame(data, "k string, d date, v double"), "k", "d")
    found = value_on(spark.createDataFrame(asked, "i int, k string, day date"), runs, "k", "day", "d", ["v"])
    got = {r.i: (r.known_day, r.v) for r in found.collect()}
    for i, k, day in asked:
        before = [(d, v) for key, d, v in data if key == k and day is not None and d <= day]
        assert got[i] == (before[-1] if before else (None, None))
    assert len(got) == 2000


def test_period_sums_are_differences_of_two_rows(spark, tmp_path):
    rng = random.Random(8)
    days = [date(2023, 11, 15) + timedelta(days=i) for i in range(200)]
    data = [(rng.choice(["a", "a", "b", None]), rng.choice([*days[:90], *days[120:], None]), rng.choice([0.1, -2.7, 1e6 + 0.3, None])) for _ in range(3000)]
    df = spark.createDataFrame(data, "k string, day date, v double")
    early, late = (df.filter(f"coalesce(v, 0) {op} 0.1") for op in ("<>", "="))
    path = str(tmp_path / "totals")
    totals.write_totals(totals.daily_sums(early, "k", "day", ["v"]), "k", "day", ["v"], path)
    kept = spark.read.parquet(path)
    periods = [(days[0], days[-1]), (days[30], days[30]), (days[95], days[110]), (date(2020, 1, 1), days[40]), (days[60], date(2030, 1, 1)), (date(2019, 1, 1), date(2019, 2, 1))]
    found = totals.period_sums(kept, "k", "day", ["v"], periods, totals.daily_sums(late, "k", "day", ["v"]))
    got = {(r.period_start, r.period_end, r.k): (r.n_rows, r.v_n, r.v_sum, r.v_mean) for r in found.collect()}
    expected = {}
    for start, end in periods:
        for k in ("a", "b", None):
            inside = [v for key, d, v in data if key == k and d is not None and start <= d <= end]
            if inside:
                exact = [round(v * 10) for v in inside if v is not None]
                expected[start, end, k] = (len(inside), len(exact), sum(exact) / 10 if exact else None, pytest.approx(sum(exact) / 10 / len(exact)) if exact else None)
    assert got == expected
    one = totals.totals_on(kept, "day", days[100])
    assert one.count() == one.select("k").distinct().count() == 3
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in scan
    assert totals.period_sums(kept.limit(0), "k", "day", ["v"], periods).collect() == []


def test_totals_of_a_table_without_rows(spark, tmp_path):
    nothing = spark.createDataFrame([], "k string, day date, v double")
    running = totals.running_totals(totals.daily_sums(nothing, "k", "day", ["v"]), "k", "day", ["v"])
    assert totals.period_sums(running, "k", "day", ["v"], [(date(2024, 1, 1), date(2024, 2, 1))]).collect() == []


def test_exact_sample_of_a_table_of_copies(spark):
    df = spark.range(20000).selectExpr("id % 2 as k", "if(id % 2 = 0, null, 'x') as v")
    sample = sampling.exact_sample(df, 17000)
    counts = sorted(r["count"] for r in sample.groupBy("k", "v").count().collect())
    assert counts == [7000, 10000]
    assert sampling.exact_sample(df, 1).count() == 1 and sampling.exact_sample(df, 20000).count() == 20000 and sampling.exact_sample(df, 0).count() == 0
