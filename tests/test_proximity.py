import random

from pyspark.sql import functions as F

from beadloom.operators.proximity import close_beads, near_pairs, points_in_boxes, z_order, z_ranges

PUCK = "bead_id long, sb string, x double, y double, puck_index int"


def brute(rows, r):
    ok = [p for p in rows if None not in p and p[2] == p[2] and p[3] == p[3]]
    out = set()
    for i, a in enumerate(ok):
        for b in ok[i + 1 :]:
            if a[4] == b[4] and a[1].strip().upper() != b[1].strip().upper() and (a[2] - b[2]) * (a[2] - b[2]) + (a[3] - b[3]) * (a[3] - b[3]) <= r * r:
                out.add((min(a[0], b[0]), max(a[0], b[0])))
    return out


def test_against_brute_force_with_dirt_copies_and_edges(spark):
    rng = random.Random(4)
    rows = []
    for k in range(600):
        x, y = rng.randrange(-480, 480) / 16, rng.randrange(-480, 480) / 16
        rows.append((k, rng.choice("ACGT") + str(k % 170), x, y, rng.choice([1, 2])))
    rows += [(1000 + k, r[1].lower() + " ", r[2], r[3], r[4]) for k, r in enumerate(rows[:80])]  # delivered twice
    rows += [(2000, None, 0.0, 0.0, 1), (2001, "Z", None, 0.0, 1), (2002, "Z", float("nan"), 0.0, 1), (2003, "Z", 0.0, 0.0, None), (2004, "Z", float("inf"), 0.0, 1)]
    rows += [(3000, "P", 100.0, 100.0, 1), (3001, "Q", 102.0, 100.0, 1), (3002, "R", 104.0001, 100.0, 1), (3003, "S", 1e300, 1e300, 1), (3004, "T", 1e300, 1e300, 1)]
    got = [tuple(r) for r in close_beads(spark.createDataFrame(rows, PUCK)).collect()]
    want = brute(rows, 2.0)
    assert len(got) == len(set(got)) and set(got) == want and (3000, 3001) in want and (3003, 3004) in want


def test_a_crowd_of_copies_does_not_meet_itself(spark):
    rows = [(k, "A", 5.0, 5.0, 1) for k in range(3000)] + [(9000, "B", 5.0, 6.0, 1)]
    got = close_beads(spark.createDataFrame(rows, PUCK))
    assert got.count() == 3000 and got.filter("bead_b = 9000").count() == 3000


def test_empty_and_extra_columns(spark):
    assert close_beads(spark.createDataFrame([], PUCK)).count() == 0
    df = spark.createDataFrame([(1, "A", 0.0, 0.0, 1, 5, 6), (2, "B", 0.0, 0.0, 1, 5, 6)], PUCK + ", code int, g int")
    assert [tuple(r) for r in close_beads(df).collect()] == [(1, 2)]


def test_ranges_cover_each_cell_once(spark):
    r = spark.createDataFrame([([3, 4, 5, 7, 9],)], "c array<long>").select(z_ranges("c").alias("r")).first()["r"]
    assert [tuple(x) for x in r] == [(3, 5), (7, 7), (9, 9)]
    got = spark.createDataFrame([(5, 3), (0, 0), ((1 << 29) - 1, 1)], "a long, b long").select(z_order(F.col("a"), F.col("b")).alias("z"), "a", "b").collect()
    for row in got:
        assert row["z"] == sum(((row["a"] >> k & 1) << 2 * k) | ((row["b"] >> k & 1) << 2 * k + 1) for k in range(30))


def test_regions(spark):
    pts = spark.createDataFrame([(1, 10, 0.0, 0.0), (1, 11, 5.0, 5.0), (2, 12, 1.0, 1.0), (1, 13, float("nan"), 1.0)], "g int, ident long, x double, y double")
    boxes = spark.createDataFrame([(1, "a", -1.0, 5.0, -1.0, 5.0), (1, "b", 5.0, 9.0, 5.0, 9.0), (2, "c", 3.0, 0.0, 0.0, 3.0), (2, "d", None, 1.0, 0.0, 1.0)], "g int, box string, x0 double, x1 double, y0 double, y1 double")
    assert {tuple(r) for r in points_in_boxes(pts, boxes, 2.0).collect()} == {(10, "a"), (11, "a"), (11, "b")}


def test_regions_of_all_sizes_against_brute_force(spark):
    """From a single place to the whole plane; none is covered with more than 81 cells."""
    rng = random.Random(6)
    pts = [(rng.choice([1, 2]), k, rng.uniform(-5000, 5000), rng.uniform(-5000, 5000)) for k in range(800)]
    boxes = [(1, 0, -1e9, 1e9, -1e9, 1e9), (2, 1, float("-inf"), float("inf"), 0.0, 10.0)]
    for k in range(2, 80):
        x, y, w, h = rng.uniform(-5000, 5000), rng.uniform(-5000, 5000), 10 ** rng.uniform(-2, 4), 10 ** rng.uniform(-2, 4)
        boxes.append((rng.choice([1, 2]), k, x, x + w, y, y + h))
    got = points_in_boxes(spark.createDataFrame(pts, "g int, ident long, x double, y double"), spark.createDataFrame(boxes, "g int, box long, x0 double, x1 double, y0 double, y1 double"), 2.0)
    want = sorted((i, b) for g, i, x, y in pts for h, b, x0, x1, y0, y1 in boxes if g == h and x0 <= x <= x1 and y0 <= y <= y1)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_radius_zero_finds_equal_places(spark):
    df = spark.createDataFrame([(1, 1, 0.5, 0.5), (1, 2, 0.5, 0.5), (1, 3, 0.6, 0.5)], "g int, id long, x double, y double")
    assert [(r["a"], r["b"]) for r in near_pairs(df, 0.0, "g", "id").collect()] == [(1, 2)]
