import math
import random
import statistics
import struct

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cohortweave.catalog import QUERIES
from cohortweave.catalog import features as registered
from cohortweave.operators import density as de
from cohortweave.operators import features as fe
from cohortweave.operators import metrics as me
from cohortweave.operators import modelling as mo
from cohortweave.operators.density import exact_quantiles
from cohortweave.plans import weight_models as wm
from cohortweave.session import written


def test_join_features_is_a_full_join(spark, rows):
    a = spark.createDataFrame([(1, 10), (2, 20)], "cust_id int, a int")
    b = spark.createDataFrame([(2, 5), (3, 6)], "cust_id int, b int")
    c = spark.createDataFrame([(3, 7), (3, 8), (None, 9)], "cust_id int, c int")
    assert rows(fe.join_features([a, b, c])) == [(1, 10, None, None), (2, 20, 5, None), (3, None, 6, 7), (3, None, 6, 8)]


def test_feature_templates_use_lookback(spark, rows):
    cohort = spark.sql("SELECT 1 AS cust_id, date'2022-06-30' AS index_dt UNION ALL SELECT 2, date'2022-06-30'")
    claims = spark.sql("SELECT 1 AS cust_id, date'2021-01-01' AS d UNION ALL SELECT 1, date'2020-12-01' UNION ALL SELECT 2, date'2019-01-01'")
    text = "SELECT c.cust_id, count(*) AS n FROM {cohort} c JOIN {claims} k USING (cust_id) WHERE d >= add_months(index_dt, -:lookback_months) GROUP BY 1"
    assert rows(fe.feature_templates(cohort, {"n": text}, {"claims": claims}, 18)) == [(1, 1)]
    assert rows(fe.feature_templates(cohort, {"n": text}, {"claims": claims}, 48)) == [(1, 2), (2, 1)]


def test_household_features(small_tasks, rows):
    people = [("a", "h", 1), ("b", "h", 0), ("c", "h", 0), ("d", "solo", 1), ("e", None, 1), ("f", None, 1), ("g", "all", 1), ("i", "all", 1)]
    labels = small_tasks.createDataFrame([(c, o) for c, _, o in people], "cust_id string, obese int")
    hh = small_tasks.createDataFrame([(c, h) for c, h, _ in people if h], "cust_id string, hh_id string")
    got = rows(fe.household_features(labels, hh), "cust_id", "hh_obese", "hh_nonobese")
    assert got == [("a", 0, 1), ("b", 1, 1), ("c", 1, 1), ("d", 0, 0), ("e", 0, 0), ("f", 0, 0), ("g", 1, 0), ("i", 1, 0)]


def test_fallback_lookup(spark, rows):
    df = spark.createDataFrame([(1, "t1", "z1"), (2, "t9", "z1"), (3, None, "z1"), (4, "t2", "z9")], "id int, tract string, zip string")
    tract = spark.createDataFrame([("t1", 1.0), ("t2", None)], "t string, v double")
    zips = spark.createDataFrame([("z1", 9.0)], "z string, w double")
    got = fe.fallback_lookup(df, [("tract", tract, "t", "v"), ("zip", zips, "z", "w")], "pct")
    assert got.columns == ["id", "pct"]
    assert rows(got) == [(1, 1.0), (2, 9.0), (3, 9.0), (4, None)]


def test_select_features():
    cols = ["id", "age", "mcd_a", "mcd_foster", "cc_x", "y"]
    assert fe.select_features(cols, ["age"], ["cc_", "mcd_"], ["mcd_foster"], ["score", "age"]) == ["age", "cc_x", "mcd_a", "score"]
    with pytest.raises(ValueError):
        fe.select_features(cols, ["absent"])


def test_class_weights_count_inside_the_stratum(spark, rows):
    data = [(19, 1), (20, 1), (30, 0), (110, 0), (111, 0), (50, 0), (40, None)]
    df = spark.createDataFrame(data, "age int, obese int")
    assert rows(fe.class_weights(df, (20, 110))) == [(110, 0, 1.0), (20, 1, 3.0), (30, 0, 1.0), (40, None, None), (50, 0, 1.0)]
    none = fe.class_weights(df.where("obese = 1"), (20, 110)).first()
    assert none.weight is None


def test_household_mean_score(small_tasks, rows):
    hh = small_tasks.createDataFrame([("a", "h"), ("b", "h")], "cust_id string, hh_id string")
    scores = small_tasks.createDataFrame([("a", 0.2), ("b", 0.4), ("x", 0.9), ("y", 0.7)], "cust_id string, p1 double")
    people = small_tasks.createDataFrame([("k1", "h"), ("k2", None), ("k3", "other")], "cust_id string, hh_id string")
    plain = {r[0]: r[2] for r in rows(fe.household_mean_score(people, scores, hh))}
    assert plain == {"k1": pytest.approx(0.3), "k2": None, "k3": None}
    safe = {r[0]: r[2] for r in rows(fe.household_mean_score(people, scores, hh, null_safe=True))}
    assert safe["k2"] == pytest.approx(0.8)


def test_clean_names_and_two_period_mean(spark, rows):
    assert [fe.snake_case(n) for n in ("Pop Total 2017", "ICEwb_2018", "% poor", "geoID")] == ["pop_total_2017", "icewb_2018", "percent_poor", "geo_id"]
    df = spark.createDataFrame(
        [("t1", 5.0, 1.0, 3.0, 10, 20), ("t2", 6.0, None, 4.0, 10, 10), ("t3", 7.0, 1.0, 9.0, 0, 30), ("t4", 8.0, 1.0, 1.0, 0, None)],
        ["GEOID", "ds pm pred", "Crowding 2017", "Crowding 2018", "Pop Total 2017", "Pop Total 2018"],
    )
    got = fe.two_period_mean(df, ["geoid", "ds_pm_pred"], [2017, 2018])
    assert rows(got, "geoid", "crowding", "pop_total") == [("t1", 2.0, 15.0), ("t2", 4.0, 10.0), ("t3", 9.0, 30.0)]


def test_density_input(small_tasks, rows):
    members = small_tasks.createDataFrame([("a", "G1"), ("b", "G2"), ("c", "G1")], "cust_id string, ltc_cat_simple string")
    geo = small_tasks.createDataFrame([("a", 0.5, 100.0), ("b", None, 50.0), ("z", 0.1, 1.0)], "cust_id string, ice_wb double, pop_total double")
    tracts = small_tasks.createDataFrame([(0.2, 1000.0)], "ice_wb double, pop_total double")
    assert rows(de.density_input(members, geo, tracts, ["ice_wb", "pop_total"])) == [
        ("G1", 1.0, "ice_wb", 0.5), ("G1", 1.0, "pop_total", 100.0), ("NY Overall", 1000.0, "ice_wb", 0.2), ("NY Overall", 1000.0, "pop_total", 1000.0),
    ]


def quantile(values, p):
    values = sorted(values)
    h = (len(values) - 1) * p
    low = math.floor(h)
    return values[low] + (values[math.ceil(h)] - values[low]) * (h - low)


@pytest.mark.parametrize("sliver", [2, 1000])
def test_exact_quantiles_at_any_refinement(spark, sliver):
    rng = random.Random(2)
    groups = {"skewed": [rng.expovariate(1) ** 3 for _ in range(301)], "copies": [1.5] * 50 + [2.5] * 3, "one": [4.0], "neg": [-rng.random() for _ in range(20)]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("one", None)], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r[0]: r[1:] for r in de.exact_quantiles(df, ["g"], "v", probs, sliver=sliver).collect()}
    for g, vs in groups.items():
        assert list(got[g]) == pytest.approx([quantile(vs, p) for p in probs])


def test_weighted_density_integrates_and_matches_formula(spark):
    rng = random.Random(4)
    data = [("x", g, rng.gauss(m, 1.0), rng.random()) for g, m, n in (("a", 0, 300), ("b", 4, 80)) for _ in range(n)]
    data += [("flat", "a", 3.0, 1.0), ("flat", "a", 3.0, 2.0), ("x", "weightless", 1.0, 0.0), ("x", "a", None, 1.0)]
    df = spark.createDataFrame(data, "variable string, grouping_var string, value double, weight_tract double")
    got = de.weighted_density(df, n=256).collect()
    assert {(r.variable, r.grouping_var) for r in got} == {("x", "a"), ("x", "b"), ("flat", "a")}
    for g in ("a", "b"):
        points = sorted((r.x, r.density) for r in got if r.variable == "x" and r.grouping_var == g)
        assert len(points) == 256
        area = sum((x1 - x0) * (d0 + d1) / 2 for (x0, d0), (x1, d1) in zip(points, points[1:]))
        assert area == pytest.approx(1, abs=0.05)
        own = [(v, w) for var, gg, v, w in data if var == "x" and gg == g and v is not None]
        values, total = [v for v, _ in own], sum(w for _, w in own)
        iqr = quantile(values, 0.75) - quantile(values, 0.25)
        bw = 0.9 * min(statistics.stdev(values), iqr / 1.34) * len(values) ** -0.2
        for x, d in points[::51]:
            exact = sum(w * math.exp(-0.5 * ((x - v) / bw) ** 2) for v, w in own) / (total * bw * math.sqrt(2 * math.pi))
            assert d == pytest.approx(exact, abs=2e-3)


def training(spark):
    rng = random.Random(1)
    data = [(f"c{i}", rng.random(), None if i % 17 == 0 else rng.randint(0, 5)) for i in range(240)]
    rows = [(c, x, n, int(x + 0.3 * rng.random() > 0.6), rng.choice([1.0, 2.0])) for c, x, n in data]
    return spark.createDataFrame(rows, "cust_id string, x double, n int, obese int, weight double")


def test_model_search_leaderboard_save_and_score(spark, tmp_path):
    df = training(spark)
    candidates = [
        mo.Candidate("glm", (("regParam", 0.01), ("elasticNetParam", 0.0))),
        mo.Candidate("glm", (("regParam", 5.0), ("elasticNetParam", 0.0))),
        mo.Candidate("glm", (("regParam", 5.0), ("elasticNetParam", 1.0))),
        mo.Candidate("gbm", (("maxIter", 2), ("maxDepth", 2), ("stepSize", 0.1))),
    ]
    result = mo.model_search(df, ["x", "n"], folds=2, candidates=candidates, rounds=1)
    # the second lot brings no gain, so the search ends there
    board = mo.leaderboard(spark, result).collect()
    assert [r.rank for r in board] == [1, 2] and board[0].logloss < board[1].logloss and board[0].params.startswith("regParam=0.01")
    metrics = mo.evaluate(result.best, df).first()
    assert metrics.n == 240 and metrics.auc > 0.9 and metrics.logloss < 0.5
    path = str(tmp_path / "model")
    mo.save_model(result.best, path)
    before = {r.cust_id: r.p1 for r in mo.score(result.best, df).collect()}
    after = {r.cust_id: r.p1 for r in mo.score(mo.load_model(path), df).collect()}
    assert before == after and len(before) == 240 and all(0 <= p <= 1 for p in before.values())


def test_boosted_trees_and_default_candidates(spark):
    result = mo.model_search(training(spark), ["x", "n"], folds=2, candidates=[mo.Candidate("gbm", (("maxIter", 2), ("maxDepth", 2), ("stepSize", 0.1)))])
    assert result.rows[0][1] == "gbm"
    assert len(mo.default_candidates(5)) == 5 and {c.algo for c in mo.default_candidates()} == {"glm", "gbm"}
    assert len(mo.default_candidates()) <= 50
    with pytest.raises(ValueError):
        mo.model_search(training(spark), ["x"], folds=2, candidates=[mo.Candidate("svm", ())])


def test_images_keep_the_order_of_doubles(spark):
    rng = random.Random(3)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3_000)]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1.0, 0.1]
    values = [v for v in values if math.isfinite(v)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", de.ordered_image(F.col("v")).alias("i")).collect()
    for r in got:
        size = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.i == (-size if r.v < 0 else size)
    assert [r.v for r in sorted(got, key=lambda r: r.i)] == sorted(values)


@pytest.mark.parametrize(
    "values",
    [
        [0.0] * 20 + [5e-324] * 20,
        [-0.0] * 9 + [0.0] * 9 + [-5e-324] * 9,
        [5e-324 * i for i in range(60)],
        [-1.7976931348623157e308] * 15 + [1.7976931348623157e308] * 16,
        [1.0 + i * 2.0**-52 for i in range(50)] + [-1e300, 1e300],
        [(-1) ** i * 2.0 ** (40 * i - 1000) for i in range(50)],
    ],
)
def test_quantiles_of_any_finite_values_take_at_most_six_rounds(spark, values, monkeypatch):
    rounds = []
    monkeypatch.setattr(de, "written", lambda df, name: rounds.append(name) or written(df, name))
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    found = de.exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0], sliver=1).first()
    assert list(found)[1:] == [quantile(values, p) for p in (0.0, 0.5, 1.0)]
    assert rounds.count("ranks") <= 6


def test_quantiles_leave_out_values_that_are_not_finite(spark):
    values = [float(i) for i in range(60)] + [float("nan"), float("inf"), float("-inf"), -1.7e308, 1.7e308]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    found = exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0], sliver=5).first()
    assert (found.q0, found.q1, found.q2) == (-1.7e308, 29.5, 1.7e308)


def test_features_join_without_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("class_weights", "assembled_features"):
            assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_held_out_rows_are_a_fifth_of_the_keys_and_apart(spark):
    df = spark.range(1000).select((F.col("id") % 500).alias("cust_id"), "id")
    train, test = mo.hold_out(df)
    assert train.count() + test.count() == 1000
    assert train.join(test, "cust_id").count() == 0
    assert 130 < test.count() < 270


def brute_auc(rows):
    pos, neg = [(s, w) for y, w, s in rows if y == 1], [(s, w) for y, w, s in rows if y == 0]
    if not pos or not neg:
        return None
    wins = sum(wp * wn * (1.0 if sp > sn else 0.5 if sp == sn else 0.0) for sp, wp in pos for sn, wn in neg)
    return wins / (sum(w for _, w in pos) * sum(w for _, w in neg))


def test_weighted_auc_and_losses_match_all_pairs(spark):
    rng = random.Random(9)
    groups = {g: [(rng.randint(0, 1), rng.choice([0.5, 1.0, 3.0]), round(rng.random(), 1 + g % 2)) for _ in range(90)] for g in range(4)}
    groups[7] = [(1, 1.0, 0.5)] * 3
    groups[None] = [(1, 2.0, 1.0), (0, 1.0, 0.0), (0, 1.0, 1.0)]
    rows = [(g, *r) for g, rs in groups.items() for r in rs]
    odd = [(0, None, 1.0, 0.3), (0, 1, None, 0.3), (0, 1, 1.0, None), (0, 1, 1.0, float("nan"))]
    df = spark.createDataFrame(rows + odd, "g int, obese int, weight double, p1 double")
    auc = {r.g: r.auc for r in me.weighted_auc(df, by=["g"]).collect()}
    losses = {r.g: r for r in me.weighted_losses(df, by=["g"]).collect()}
    assert set(auc) == set(groups) == set(losses)
    for g, rs in groups.items():
        assert auc[g] == (None if brute_auc(rs) is None else pytest.approx(brute_auc(rs)))
        total = sum(w for _, w, _ in rs)
        clipped = [(y, w, min(max(s, me.EPSILON), 1 - me.EPSILON)) for y, w, s in rs]
        loss = -sum(w * math.log(s if y else 1 - s) for y, w, s in clipped) / total
        assert losses[g].logloss == pytest.approx(loss) and losses[g].n == len(rs)
        assert losses[g].accuracy == pytest.approx(sum(w for y, w, s in rs if (s > 0.5) == (y == 1)) / total)
    assert me.weighted_auc(df.limit(0)).first().auc is None


def test_first_trees_are_the_model_of_fewer_trees(spark):
    """Losses after 2 of 5 trees equal those of a model of 2 trees, by Spark's own evaluator."""
    rows = mo._preparation(["x", "n"]).fit(training(spark)).transform(training(spark)).withColumns({c: F.col(c).cast("double") for c in ("obese", "weight")})
    rows = rows.withColumn("__test", F.pmod(F.hash("cust_id"), F.lit(3)) == 0).persist()
    few, many = (mo.Candidate("gbm", (("maxDepth", 3), ("stepSize", 0.1), ("maxIter", i))) for i in (2, 5))
    evaluator = MulticlassClassificationEvaluator(metricName="logLoss", labelCol="obese", weightCol="weight")
    test = rows.where("__test")
    long = mo._learner(many, "obese", "weight", 1).fit(rows.where("not __test"))
    short = mo._learner(few, "obese", "weight", 1).fit(rows.where("not __test"))
    told = mo._fold_losses(long, test, [few, many], "obese", "weight")
    assert told == pytest.approx([evaluator.evaluate(short.transform(test)), evaluator.evaluate(long.transform(test))])
    ended = mo._fit_fold(rows, mo.Candidate("gbm", (("maxDepth", 3), ("stepSize", 0.1), ("maxIter", 30))), "obese", "weight", 1, 0.2)
    assert 1 <= ended.getNumTrees < 30
    cut = mo._learner(mo.Candidate("gbm", (("maxDepth", 3), ("stepSize", 0.1), ("maxIter", ended.getNumTrees))), "obese", "weight", 1).fit(rows.where("not __test"))
    assert mo._fold_losses(ended, test, [many], "obese", "weight")[0] == pytest.approx(evaluator.evaluate(cut.transform(test)))


def test_training_rows_are_scored_by_models_that_have_not_seen_them(spark, tmp_path):
    df = training(spark).withColumn("home", F.concat(F.lit("h"), F.substring("cust_id", 2, 1)))
    result = mo.model_search(df, ["x", "n"], fold_key="home", folds=3, candidates=[mo.Candidate("glm", (("regParam", 0.01), ("elasticNetParam", 0.0)))])
    scores = mo.cross_validated_scores(result)
    rows = {r.cust_id: r for r in scores.collect()}
    assert len(rows) == 240 and {r.fold for r in rows.values()} == {0, 1, 2}
    homes = {r.cust_id: r.home for r in df.collect()}
    assert len({(homes[c], r.fold) for c, r in rows.items()}) == len(set(homes.values()))
    for fold in range(3):
        rest = [c for c, r in rows.items() if r.fold != fold]
        prepare = mo._preparation(["x", "n"]).fit(df.where(F.col("cust_id").isin(rest)).withColumns({c: F.col(c).cast("double") for c in ("x", "n")}))
        assert list(prepare.stages[0].surrogateDF.first()) == pytest.approx(list(result.fold_models[fold].stages[0].surrogateDF.first()))
    mo.save_fold_models(result, str(tmp_path / "folds"))
    again = mo.cross_validated_scores(result, mo.load_fold_models(str(tmp_path / "folds"), 3))
    assert {r.cust_id: r.p1 for r in again.collect()} == {c: r.p1 for c, r in rows.items()}


def test_folds_are_the_same_in_sql(spark):
    import duckdb

    ids = [str(i) for i in range(300)] + ["ä", ""]
    got = {r.k: r.f for r in spark.createDataFrame([(i,) for i in ids], "k string").select("k", mo.fold_of("k").alias("f")).collect()}
    for k in ids:
        assert got[k] == duckdb.execute("SELECT ('0x' || substr(md5('789:' || ?), 1, 8))::BIGINT % 10", [k]).fetchone()[0]


def test_stacked_children_see_no_score_of_a_model_trained_on_their_household(spark):
    rng = random.Random(2)
    people = [(f"p{i}", i % 40 if i % 9 else None, rng.choice([10, 40]), rng.randint(0, 1), rng.random()) for i in range(240)]
    labelled = spark.createDataFrame(people, "cust_id string, hh_id int, age int, obese int, x double")
    rules = wm.ModelRules(search={"folds": 4, "candidates": [mo.Candidate("glm", (("regParam", 0.01), ("elasticNetParam", 0.0)))]})
    adults, children = wm.stacked_models(labelled, ["x"], ["x"], rules)
    scores = {r.cust_id: r for r in mo.cross_validated_scores(adults).collect()}
    home = {p[0]: p[1] for p in people}
    assert set(scores) == {p[0] for p in people if p[2] == 40}
    for h in {h for h in home.values() if h is not None}:
        assert len({r.fold for c, r in scores.items() if home[c] == h}) <= 1
    means = {}
    for c, r in scores.items():
        if home[c] is not None:
            means.setdefault(home[c], []).append(r.p1)
    for r in children.training.collect():
        wanted = means.get(home[r.cust_id])
        assert r[wm.HOUSEHOLD_SCORE] == (pytest.approx(sum(wanted) / len(wanted)) if wanted else None)
    board = wm.leaderboards(adults, children).collect()
    assert {r.stratum for r in board} == {wm.ADULTS, wm.CHILDREN}
    adults, children = wm.stacked_models(labelled.where("age = 40"), ["x"], ["x"], rules)
    assert children is None and {r.stratum for r in wm.leaderboards(adults, children).collect()} == {wm.ADULTS}


def test_registered_model_queries_end_with_all_candidates_and_folds(spark):
    """Whole searches, run to their end: 10 folds, every default candidate until a lot brings no gain."""
    sf = "/root/testdata/sf0.001"
    board = QUERIES["model_leaderboard"](spark, sf).collect()
    (search,) = [s for (_, d), s in registered._SEARCHES.items() if d == sf]
    assert len(search.fold_models) == mo.FOLDS == 10 and len(mo.default_candidates()) == 21
    names = [(c.algo, c.describe()) for c in mo.default_candidates()]
    assert [(algo, params) for _, algo, params, _ in search.rows] == names[: len(board)]
    ended = len(board)
    if ended < 21:
        losses = [r[3] for r in search.rows]
        assert ended % mo.ROUNDS == 0 and min(losses[: -mo.ROUNDS]) - min(losses) <= mo.TOLERANCE
    row = QUERIES["model_evaluation"](spark, sf).first()
    ages = fe.class_weights(mo.hold_out(registered.labelled(spark, sf))[1], (20, 110))
    assert row.n == ages.where("obese IS NOT NULL").count() and row.logloss > 0
    scores = {r.cust_id: r.p1 for r in QUERIES["saved_model_scores"](spark, sf).collect()}
    assert len(scores) == 150 and all(0 <= p <= 1 for p in scores.values())
    folds = QUERIES["cross_validated_scores"](spark, sf)
    assert folds.count() == search.training.count() == folds.select("cust_id").distinct().count()


def test_features_without_values_are_left_out_of_the_models_that_saw_none(spark):
    rng = random.Random(4)
    homes = [f"h{i}" for i in range(40)]
    alone = next(h for h in homes if spark.range(1).select(F.lit(h).alias("h")).select(mo.fold_of("h", 3).alias("f")).first().f == 1)
    people = [(f"p{i}", homes[i % 40], rng.randint(0, 1), 1.0, rng.random(), None, rng.choice([None, float("nan")])) for i in range(240)]
    people = [(*p[:5], rng.random(), p[6]) if p[1] == alone else p for p in people]
    df = spark.createDataFrame(people, "cust_id string, home string, obese int, weight double, x double, rare double, never double")
    cs = [mo.Candidate("glm", (("regParam", 0.01), ("elasticNetParam", 0.0))), mo.Candidate("gbm", (("maxDepth", 2), ("stepSize", 0.1), ("maxIter", 3)))]
    search = mo.model_search(df, ["x", "rare", "never"], fold_key="home", folds=3, candidates=cs)
    assert search.best.stages[0].getInputCols() == ["x", "rare"]
    assert [m.stages[0].getInputCols() for m in search.fold_models] == [["x", "rare"], ["x"], ["x", "rare"]]
    scores = mo.cross_validated_scores(search)
    assert scores.count() == 240 and scores.where("p1 between 0 and 1").count() == 240
    assert mo.score(search.best, df).where("p1 between 0 and 1").count() == 240


def test_trees_are_fitted_to_distinct_rows_with_the_losses_of_all_rows(spark, monkeypatch):
    rng = random.Random(6)
    kinds = [(rng.choice([0.0, 1.0, None, float("nan")]), float(rng.randint(0, 9))) for _ in range(30)]
    rows = [(f"p{i}", int(rng.random() < (0.8 if 3 <= k[1] <= 6 else 0.2)), rng.choice([0.5, 1.0]), *k) for i, k in ((i, rng.choice(kinds)) for i in range(1500))]
    df = spark.createDataFrame(rows, "cust_id string, obese int, weight double, flag double, n double")
    cs = [
        mo.Candidate("gbm", (("maxDepth", 3), ("stepSize", 0.1), ("maxIter", 4))),
        mo.Candidate("glm", (("regParam", 0.01), ("elasticNetParam", 0.0))),
        mo.Candidate("gbm", (("maxDepth", 3), ("stepSize", 0.1), ("maxIter", 8))),
    ]
    seen, whole = [], mo._fit_fold
    monkeypatch.setattr(mo, "_fit_fold", lambda held, c, *rest: seen.append((c.algo, held.count(), held.agg(F.sum("weight")).first()[0])) or whole(held, c, *rest))

    def search():
        seen.clear()
        return mo.model_search(df, ["flag", "n"], folds=3, candidates=cs), list(seen)

    few, fits = search()
    weights = sum(r[2] for r in rows)
    assert all(n == 1500 if algo == "glm" else n <= 2 * 2 * 30 for algo, n, _ in fits)
    assert all(w == pytest.approx(weights) for _, _, w in fits)
    monkeypatch.setattr(mo, "ROWS_TO_ONE", math.inf)
    every, fits = search()
    assert {n for _, n, _ in fits} == {1500}
    assert [r[1:3] for r in few.rows] == [r[1:3] for r in every.rows]
    assert [r[3] for r in few.rows] == pytest.approx([r[3] for r in every.rows])
    assert few.candidate == every.candidate and few.candidate.algo == "gbm"
    for a, b in ((mo.score(few.best, df), mo.score(every.best, df)), (mo.cross_validated_scores(few), mo.cross_validated_scores(every))):
        wanted = {r.cust_id: r.p1 for r in b.collect()}
        assert len(wanted) == 1500 and {r.cust_id: r.p1 for r in a.collect()} == pytest.approx(wanted)


def test_a_fold_model_of_no_more_trees_than_the_best_candidate_is_not_fitted_again(spark, monkeypatch):
    cs = [mo.Candidate("gbm", (("maxDepth", 2), ("stepSize", 0.1), ("maxIter", i))) for i in (3, 30)]
    df = spark.createDataFrame([(f"p{i}", i % 2, 1.0, float(i % 7)) for i in range(300)], "cust_id string, obese int, weight double, x double")
    fits, whole = [], mo._fit_fold
    monkeypatch.setattr(mo, "_fit_fold", lambda held, c, *rest: fits.append(c) or whole(held, c, *rest))
    search = mo.model_search(df, ["x"], folds=3, candidates=cs, tolerance=0.05)
    assert search.candidate == cs[0] and [m.stages[-1].getNumTrees for m in search.fold_models] == [1, 1, 1]
    assert fits == [cs[1]] * 3


def test_stacked_models_of_children_whose_households_have_no_scored_adult(spark):
    rng = random.Random(5)
    people = [(f"p{i}", i % 60, 40 if i % 60 < 30 else 10, rng.randint(0, 1), rng.random()) for i in range(360)]
    labelled = spark.createDataFrame(people, "cust_id string, hh_id int, age int, obese int, x double")
    rules = wm.ModelRules(search={"folds": 3, "candidates": [mo.Candidate("glm", (("regParam", 0.01), ("elasticNetParam", 0.0)))]})
    adults, children = wm.stacked_models(labelled, ["x"], ["x"], rules)
    assert children.training.count() == 180 and children.training.where(F.col(wm.HOUSEHOLD_SCORE).isNotNull()).count() == 0
    assert {r.stratum for r in wm.leaderboards(adults, children).collect()} == {wm.ADULTS, wm.CHILDREN}
