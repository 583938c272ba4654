import numpy as np

from flowguard.operators import profile


def _quantiles_equal_numpy(spark, columns, groups, probs=(0.0, 0.25, 0.5, 0.75, 0.9, 1.0)):
    names = [f"c{i}" for i in range(len(columns))]
    rows = list(zip(groups, *[[None if v is None else float(v) for v in c] for c in columns]))
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{c} double" for c in names)).repartition(3)
    got = {(r["g"], r["feature"], r["p"]): r["q"] for r in profile.exact_quantiles(df, names, probs, "g").collect()}
    want = {}
    for g in set(groups) - {None}:
        for name, c in zip(names, columns):
            v = np.array(sorted((float(x) for x, h in zip(c, groups) if h == g and x is not None), key=lambda x: (np.isnan(x), x)))
            for p in probs if len(v) else ():
                at = (len(v) - 1) * p
                a, b = v[int(np.floor(at))], v[int(np.ceil(at))]
                want[g, name, p] = a if a == b or np.isnan(a) and np.isnan(b) else a + (b - a) * (at - np.floor(at))
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k] == w or np.isnan(got[k]) and np.isnan(w) or abs(got[k] - w) <= 1e-12 * abs(w), k


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    groups = [str(g) for g in range(3) for _ in range(101 + 50 * g)]
    n = len(groups)
    holes = [None if rng.random() < 0.3 else v for v in rng.normal(size=n)]
    _quantiles_equal_numpy(spark, [rng.normal(size=n).round(3), holes, rng.integers(0, 3, n)], groups)


def test_exact_quantiles_of_values_that_no_sketch_tells_apart(spark):
    """Values that differ in their last bits only, huge and tiny ones, ties, infinities, NaN, zeros of both signs."""
    rng = np.random.default_rng(2)
    n = 3000
    close = 1.0 + rng.integers(0, 5000, n) * np.finfo(float).eps
    ladder = np.sign(rng.normal(size=n)) * 10.0 ** rng.integers(-300, 300, n)
    tiny = rng.integers(-50, 50, n) * 5e-324
    odd = rng.choice([np.inf, -np.inf, np.nan, 0.0, -0.0, 1.0], n)
    ties = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n))
    one = [None] * (n - 1) + [3.5]
    groups = [["a", "b", None, "lone"][i] for i in rng.choice(3, n - 1)] + ["lone"]
    _quantiles_equal_numpy(spark, [close, ladder, tiny, odd, ties, one], groups)


def test_quantile_rounds_are_bounded(spark, monkeypatch):
    """A window ranks at most 2 ** QUANTILE_BITS counts of a group and column; fewer bits only take more rounds."""
    seen = []
    real = profile._next_bits

    def watch(*args):
        out = real(*args).persist()
        seen.append(out.groupBy("_g", "_f", "_t").count().agg({"count": "max"}).first()[0] or 0)
        return out
    monkeypatch.setattr(profile, "_next_bits", watch)
    monkeypatch.setattr(profile, "QUANTILE_BITS", 8)
    x = 1.0 + np.random.default_rng(3).permutation(20000) * np.finfo(float).eps
    df = spark.createDataFrame([(float(v),) for v in x], "a double")
    got = {r["p"]: r["q"] for r in profile.exact_quantiles(df, ["a"], [0.5, 0.999]).collect()}
    assert got[0.5] == np.percentile(x, 50) and abs(got[0.999] - np.percentile(x, 99.9)) < 1e-15
    assert max(seen) <= 256 and len(seen) == 8
    assert profile.exact_quantiles(df.limit(0), ["a"], [0.5]).count() == 0


def test_medians_interpolate(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "a double")
    assert profile.medians(df, ["a"]).first()["median"] == 3.0


def test_zero_variance_rules(spark):
    rows = [(0.1, None, 5.0, float(i)) for i in range(100)]
    rows[0] = (0.1, None, 5.0, 0.0)
    df = spark.createDataFrame(rows, "c double, n double, one double, x double")
    df = df.withColumn("one", df["one"] * (df["x"] == 3).cast("double") + 0.0)
    zv = {r["feature"]: r["reason"] for r in profile.zero_variance(df, ["c", "n", "x"]).collect()}
    assert zv == {"c": "zero_variance", "n": "all_null"}


def test_redundant_not_greedy(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=200)
    rows = [(float(x), float(x + 1e-3 * i % 7), float(x * 2 + 1e-3), float(rng.normal())) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "A double, B double, C double, D double")
    pairs = profile.corr_pairs(df, ["A", "B", "C", "D"])
    high = profile.high_corr_pairs(pairs)
    red = {r["feature"] for r in profile.redundant_features(high).collect()}
    assert red == {"B", "C"}   # B goes although A survives; C goes although B is dropped too


def test_corr_same_rule_at_every_width(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(1e6, 3.0, (400, 12))
    x[:, 1] = 2 * x[:, 0] + rng.normal(0, 1, 400)
    gone = rng.random((400, 12)) < 0.3
    gone[:, 11] = np.arange(400) % 2 == 0
    x[:, 10] = np.where(gone[:, 11], rng.normal(0, 1, 400), 7.0)  # constant in the rows that column 11 has
    x[5, 9], gone[5, 9] = np.inf, False
    rows = [tuple(None if g else float(v) for v, g in zip(*r)) for r in zip(x, gone)]
    names = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    wide = {(r["feature_a"], r["feature_b"]): r["r"] for r in profile.corr_pairs(df, names).collect()}
    assert len(wide) == 66
    two = profile.corr_pairs(df, names[:2]).first()["r"]
    assert abs(two - wide["c0", "c1"]) < 1e-12
    for (a, b), r in wide.items():
        i, j = int(a[1:]), int(b[1:])
        both = ~gone[:, i] & ~gone[:, j]
        if 9 in (i, j) and both[5] or (i, j) == (10, 11):
            assert np.isnan(r)
        else:
            assert abs(r - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
