import math
import statistics

from textforge.operators import profile as P


def test_curve_equals_the_direct_sum(spark):
    values = {"a": [1, 2, 2, 7, 40], None: [3, 5], "one": [4], "same": [6, 6, 6], "nulls": [None]}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v long")
    found = {(r.g, r.point): (r.x, r.density) for r in P.density(df, "v", "g", points=50).collect()}
    assert len(found) == 2 * 50
    for group in ("a", None):
        vs = values[group]
        width = statistics.stdev(vs) * len(vs) ** -0.2
        for point in range(50):
            x = min(vs) - 3 * width + point * (max(vs) - min(vs) + 6 * width) / 49
            want = sum(math.exp(-(((x - v) / width) ** 2) / 2) for v in vs) / (len(vs) * width * math.sqrt(2 * math.pi))
            got = found[group, point]
            assert abs(got[0] - x) < 1e-9 and abs(got[1] - want) < 1e-9
    whole = P.density(df.where("g = 'a'"), "v").collect()
    assert len(whole) == 200 and P.density(df.where("v < 0"), "v", "g").count() == 0
