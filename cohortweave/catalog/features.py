"""Features, training sets, models and densities on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortweave.catalog.registry import query
from cohortweave.catalog.views import claims_v, members_v, table
from cohortweave.operators import density as de
from cohortweave.operators import features as fe
from cohortweave.operators import metrics as me
from cohortweave.operators import modelling as mo
from cohortweave.session import shared_path

# ---- feature templates

_COHORT = "cohort AS (SELECT person_id AS cust_id, DATE '1999-06-01' + CAST(person_id % 300 AS INT) AS index_dt FROM members_v)"
TEMPLATES = {
    "utilisation": """
        SELECT c.cust_id, count(*) AS n_claims, count(k.admission_dt) AS n_stays
        FROM {cohort} c JOIN {claims} k ON k.person_id = c.cust_id
        WHERE k.from_dt < c.index_dt AND k.from_dt >= add_months(c.index_dt, -:lookback_months)
        GROUP BY c.cust_id""",
    "status": """
        SELECT c.cust_id, max(CASE WHEN k.status = 'P' THEN 1 ELSE 0 END) AS any_pending
        FROM {cohort} c JOIN {claims} k ON k.person_id = c.cust_id
        WHERE k.from_dt < c.index_dt AND k.from_dt >= add_months(c.index_dt, -2 * :lookback_months)
        GROUP BY c.cust_id""",
    "residence": """
        SELECT c.cust_id, floor(datediff(c.index_dt, m.birth_dt) / 365.25) AS age, m.region_cd AS zip_cd,
               CASE WHEN m.region_cd >= 5 THEN m.region_cd END AS fips_census_tract_cd
        FROM {cohort} c JOIN {members} m ON m.person_id = c.cust_id""",
}
_TEMPLATE_SQL = (
    _COHORT
    + """,
    util AS (SELECT cust_id, count(*) AS n_claims, count(admission_dt) AS n_stays FROM cohort JOIN claims_v ON person_id = cust_id
             WHERE from_dt < index_dt AND from_dt >= index_dt - INTERVAL 18 MONTH GROUP BY cust_id),
    stat AS (SELECT cust_id, max(CASE WHEN status = 'P' THEN 1 ELSE 0 END) AS any_pending FROM cohort JOIN claims_v ON person_id = cust_id
             WHERE from_dt < index_dt AND from_dt >= index_dt - INTERVAL 36 MONTH GROUP BY cust_id),
    resi AS (SELECT cust_id, CAST(floor(CAST(index_dt - birth_dt AS INT) / 365.25) AS BIGINT) AS age, region_cd AS zip_cd,
                    CASE WHEN region_cd >= 5 THEN region_cd END AS fips_census_tract_cd
             FROM cohort JOIN members_v ON person_id = cust_id),
    feats AS (SELECT * FROM util FULL JOIN stat USING (cust_id) FULL JOIN resi USING (cust_id))
"""
)


def cohort(spark, sf_dir):
    k = F.col("person_id")
    start = F.lit("1999-06-01").cast("date")
    return members_v(spark, sf_dir).select(k.alias("cust_id"), F.date_add(start, (k % 300).cast("int")).alias("index_dt"))


def template_features(spark, sf_dir):
    tables = {"claims": claims_v(spark, sf_dir), "members": members_v(spark, sf_dir)}
    return fe.feature_templates(cohort(spark, sf_dir), TEMPLATES, tables, lookback_months=18)


@query("feature_templates", "WITH " + _TEMPLATE_SQL + "SELECT * FROM feats")
def feature_templates(spark, sf_dir):
    return template_features(spark, sf_dir)


_HH_LABELS = "lab AS (SELECT person_id AS cust_id, hh_id, CASE WHEN balance > 4500 THEN 1 ELSE 0 END AS obese FROM members_v)"
_HH = (
    _HH_LABELS
    + """,
    hhsum AS (SELECT hh_id, sum(obese) AS ones, sum(1 - obese) AS zeros FROM lab WHERE hh_id IS NOT NULL GROUP BY hh_id),
    hh AS (SELECT cust_id, hh_id, CASE WHEN ones - obese >= 1 THEN 1 ELSE 0 END AS hh_obese,
                  CASE WHEN zeros - (1 - obese) >= 1 THEN 1 ELSE 0 END AS hh_nonobese
           FROM lab LEFT JOIN hhsum USING (hh_id))
"""
)


def _labels(spark, sf_dir):
    return members_v(spark, sf_dir).select(
        F.col("person_id").alias("cust_id"), F.when(F.col("balance") > 4500, 1).otherwise(0).alias("obese")
    )


def _households(spark, sf_dir):
    return members_v(spark, sf_dir).select(F.col("person_id").alias("cust_id"), "hh_id")


def _household_features(spark, sf_dir):
    return fe.household_features(_labels(spark, sf_dir), _households(spark, sf_dir))


@query("household_features", "WITH " + _HH + "SELECT * FROM hh")
def household_features(spark, sf_dir):
    return _household_features(spark, sf_dir)


_AREAS = """
    tract AS (SELECT n_nationkey AS tract, CASE WHEN n_nationkey < 15 THEN n_nationkey * 1.5e0 END AS pct FROM nation),
    zip AS (SELECT n_nationkey AS zip, n_regionkey + 30.25e0 AS pct FROM nation)
"""


def _areas(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    tract = nation.select(
        F.col("n_nationkey").alias("tract"),
        F.when(F.col("n_nationkey") < 15, F.col("n_nationkey") * F.lit(1.5)).alias("obese_pct_tract"),
    )
    zips = nation.select(F.col("n_nationkey").alias("zip"), (F.col("n_regionkey") + F.lit(30.25)).alias("obese_pct_zip"))
    return [("fips_census_tract_cd", tract, "tract", "obese_pct_tract"), ("zip_cd", zips, "zip", "obese_pct_zip")]


_FALLBACK = """
    placed AS (SELECT person_id, region_cd AS zip_cd, CASE WHEN region_cd >= 5 THEN region_cd END AS fips FROM members_v)
"""


@query(
    "fallback_lookup",
    "WITH "
    + _AREAS
    + ","
    + _FALLBACK
    + "SELECT person_id, coalesce(tract.pct, zip.pct) AS cdc_obese_pct FROM placed LEFT JOIN tract ON fips = tract LEFT JOIN zip ON zip_cd = zip",
)
def fallback_lookup(spark, sf_dir):
    placed = members_v(spark, sf_dir).select(
        "person_id",
        F.col("region_cd").alias("zip_cd"),
        F.when(F.col("region_cd") >= 5, F.col("region_cd")).alias("fips_census_tract_cd"),
    )
    return fe.fallback_lookup(placed, _areas(spark, sf_dir), "cdc_obese_pct")


_ASSEMBLED = (
    _TEMPLATE_SQL
    + ","
    + _HH
    + ","
    + _AREAS
    + """,
    allfeats AS (
        SELECT cust_id, n_claims, n_stays, any_pending, age, hh_id, hh_obese, hh_nonobese, coalesce(tract.pct, zip.pct) AS cdc_obese_pct
        FROM feats LEFT JOIN hh USING (cust_id) LEFT JOIN tract ON fips_census_tract_cd = tract LEFT JOIN zip ON zip_cd = zip)
"""
)


def assembled(spark, sf_dir):
    return fe.assemble_features(
        [template_features(spark, sf_dir)], _household_features(spark, sf_dir), _areas(spark, sf_dir)
    )


@query("assembled_features", "WITH " + _ASSEMBLED + "SELECT * FROM allfeats")
def assembled_features(spark, sf_dir):
    return assembled(spark, sf_dir)


def feature_list(columns, extra=()):
    return fe.select_features(columns, ["age", "any_pending", "cdc_obese_pct"], ["n_", "hh_"], ["hh_id"], extra)


@query(
    "selected_features",
    "WITH "
    + _ASSEMBLED
    + "SELECT cust_id, age, any_pending, cdc_obese_pct, n_claims, n_stays, hh_obese, hh_nonobese FROM allfeats",
)
def selected_features(spark, sf_dir):
    df = assembled(spark, sf_dir)
    return df.select("cust_id", *feature_list(df.columns))


_LABELLED = _ASSEMBLED + ", labelled AS (SELECT cust_id, obese, allfeats.* EXCLUDE (cust_id) FROM lab LEFT JOIN allfeats USING (cust_id))"


def labelled(spark, sf_dir):
    return fe.labelled_set(_labels(spark, sf_dir), assembled(spark, sf_dir))


@query("labelled_set", "WITH " + _LABELLED + "SELECT * FROM labelled")
def labelled_set(spark, sf_dir):
    return labelled(spark, sf_dir)


@query(
    "class_weights",
    "WITH "
    + _LABELLED
    + """,
    s AS (SELECT * FROM labelled WHERE age BETWEEN 20 AND 110)
    SELECT cust_id, age, obese, CASE WHEN obese = 1 THEN (SELECT count(*) FROM s WHERE obese = 0) / (SELECT count(*) FROM s WHERE obese = 1)
           WHEN obese = 0 THEN 1.0e0 END AS weight FROM s
    """,
)
def class_weights(spark, sf_dir):
    return fe.class_weights(labelled(spark, sf_dir), (20, 110)).select("cust_id", "age", "obese", "weight")


@query(
    "household_mean_score",
    """
    WITH sc AS (SELECT o_custkey AS cust_id, max(o_totalprice) / 500000 AS p1 FROM orders GROUP BY 1),
    means AS (SELECT hh_id, avg(p1) AS m FROM sc LEFT JOIN members_v ON person_id = cust_id GROUP BY hh_id)
    SELECT person_id AS cust_id, members_v.hh_id, round(m, 9) AS hh_adult_mean_score
    FROM members_v LEFT JOIN means ON members_v.hh_id = means.hh_id
    """,
)
def household_mean_score(spark, sf_dir):
    return _household_means(spark, sf_dir)


@query(
    "household_mean_score_null_safe",
    """
    WITH sc AS (SELECT o_custkey AS cust_id, max(o_totalprice) / 500000 AS p1 FROM orders GROUP BY 1),
    means AS (SELECT hh_id, avg(p1) AS m FROM sc LEFT JOIN members_v ON person_id = cust_id GROUP BY hh_id)
    SELECT person_id AS cust_id, members_v.hh_id, round(m, 9) AS hh_adult_mean_score
    FROM members_v LEFT JOIN means ON members_v.hh_id IS NOT DISTINCT FROM means.hh_id
    """,
)
def household_mean_score_null_safe(spark, sf_dir):
    return _household_means(spark, sf_dir, null_safe=True)


def _household_means(spark, sf_dir, **options):
    scores = claims_orders(spark, sf_dir)
    people = _households(spark, sf_dir)
    means = fe.household_mean_score(people, scores, _households(spark, sf_dir), **options)
    return means.withColumn("hh_adult_mean_score", F.round("hh_adult_mean_score", 9))


def claims_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_custkey").alias("cust_id")).agg((F.max("o_totalprice") / 500000).alias("p1"))


# ---- metrics and folds: the exact parts of model training

_SCORED = """
    scored AS (
        SELECT o_orderpriority AS priority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS obese, 1e0 + o_custkey % 3 AS weight,
               round(1e0 / (1e0 + exp(-(o_totalprice / 250000e0 - 1e0 + CASE WHEN o_orderstatus = 'F' THEN 0.2e0 ELSE 0e0 END))), 4) AS p1
        FROM orders)
"""


def _scored(spark, sf_dir):
    """Rows with a fixed logistic formula as their score, rounded so that there are ties."""
    found = F.col("o_orderstatus") == "F"
    logit = F.col("o_totalprice") / 250000 - 1 + F.when(found, F.lit(0.2)).otherwise(F.lit(0.0))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.when(found, 1).otherwise(0).alias("obese"),
        (F.lit(1.0) + F.col("o_custkey") % 3).alias("weight"),
        F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)), 4).alias("p1"),
    )


@query(
    "exact_auc",
    "WITH "
    + _SCORED
    + """,
    steps AS (SELECT priority, p1, sum(CASE WHEN obese = 1 THEN weight ELSE 0 END) AS pos, sum(CASE WHEN obese = 0 THEN weight ELSE 0 END) AS neg
              FROM scored GROUP BY ALL),
    ranked AS (SELECT *, sum(neg) OVER (PARTITION BY priority ORDER BY p1) - neg AS below FROM steps)
    SELECT priority, round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) AS auc FROM ranked GROUP BY priority
    """,
)
def exact_auc(spark, sf_dir):
    return me.weighted_auc(_scored(spark, sf_dir), by=["priority"]).withColumn("auc", F.round("auc", 9))


@query(
    "weighted_losses",
    "WITH "
    + _SCORED
    + """
    SELECT priority, round(-sum(weight * ln(CASE WHEN obese = 1 THEN p1 ELSE 1 - p1 END)) / sum(weight), 9) AS logloss,
           round(sum(CASE WHEN (p1 > 0.5) = (obese = 1) THEN weight ELSE 0 END) / sum(weight), 9) AS accuracy, count(*) AS n
    FROM scored GROUP BY priority
    """,
)
def weighted_losses(spark, sf_dir):
    losses = me.weighted_losses(_scored(spark, sf_dir), by=["priority"])
    return losses.withColumns({c: F.round(c, 9) for c in ("logloss", "accuracy")})


@query(
    "score_calibration",
    "WITH "
    + _SCORED
    + """
    SELECT priority, CAST(least(floor(p1 * 10), 9) AS INT) AS bin, count(*) AS n, round(sum(p1 * weight) / sum(weight), 9) AS mean_score,
           round(sum(CASE WHEN obese = 1 THEN weight ELSE 0 END) / sum(weight), 9) AS rate
    FROM scored GROUP BY ALL
    """,
)
def score_calibration(spark, sf_dir):
    found = me.calibration(_scored(spark, sf_dir), by=["priority"])
    return found.withColumns({c: F.round(c, 9) for c in ("mean_score", "rate")})


def _part_sql(salt: str, key: str, parts: int) -> str:
    """The SQL of ``modelling.key_hash``."""
    return f"CAST(('0x' || substr(md5('{salt}:' || {key}), 1, 8))::BIGINT % {parts} AS INT)"


@query(
    "cross_validation_folds",
    "WITH "
    + _LABELLED
    + f"""
    SELECT cust_id, {_part_sql("hold out", "cust_id", 5)} = 0 AS held_out, {_part_sql("789", "cust_id", 10)} AS fold FROM labelled
    """,
)
def cross_validation_folds(spark, sf_dir):
    held_out = (mo.key_hash("hold out", "cust_id", 5) == 0).alias("held_out")
    return labelled(spark, sf_dir).select("cust_id", held_out, mo.fold_of().alias("fold"))


# ---- models (no SQL counterpart)

ADULTS = (20, 110)
_SEARCHES: dict[tuple, mo.SearchResult] = {}


def _search(spark, sf_dir):
    """The adult search; one result serves all queries of a session."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _SEARCHES:
        train = fe.class_weights(mo.hold_out(labelled(spark, sf_dir))[0], ADULTS)
        _SEARCHES[at] = mo.model_search(train, feature_list(train.columns))
    return _SEARCHES[at]


@query("model_leaderboard")
def model_leaderboard(spark, sf_dir):
    return mo.leaderboard(spark, _search(spark, sf_dir))


@query("model_evaluation")
def model_evaluation(spark, sf_dir):
    test = fe.class_weights(mo.hold_out(labelled(spark, sf_dir))[1], ADULTS)
    return mo.evaluate(_search(spark, sf_dir).best, test)


@query("saved_model_scores")
def saved_model_scores(spark, sf_dir):
    path = shared_path(spark, "adult-model")
    mo.save_model(_search(spark, sf_dir).best, path)
    return mo.score(mo.load_model(path), labelled(spark, sf_dir))


@query("cross_validated_scores")
def cross_validated_scores(spark, sf_dir):
    """One score per training row from the reloaded model of the fold that left the row out."""
    search, path = _search(spark, sf_dir), shared_path(spark, "fold-models")
    mo.save_fold_models(search, path)
    return mo.cross_validated_scores(search, mo.load_fold_models(path))


# ---- tract values and densities

_TRACT_YEARS = """
    raw AS (
        SELECT l_suppkey AS geoid, max(l_tax) AS ds_pm_pred,
               avg(CASE WHEN year(l_shipdate) = 1997 THEN l_discount END) AS p97, avg(CASE WHEN year(l_shipdate) = 1998 THEN l_discount END) AS p98,
               max(CASE WHEN year(l_shipdate) = 1997 THEN l_quantity END) AS c97, max(CASE WHEN year(l_shipdate) = 1998 THEN l_quantity END) AS c98,
               sum(CASE WHEN year(l_shipdate) = 1997 AND l_returnflag = 'R' THEN 1 ELSE 0 END) AS n97,
               sum(CASE WHEN year(l_shipdate) = 1998 AND l_returnflag = 'A' THEN 1 ELSE 0 END) AS n98
        FROM lineitem GROUP BY 1),
    long AS (SELECT geoid, ds_pm_pred, p97 AS ice_wb, c97 AS crowding, n97 AS pop_total FROM raw
             UNION ALL SELECT geoid, ds_pm_pred, p98, c98, n98 FROM raw),
    tract_values AS (SELECT geoid, ds_pm_pred, avg(ice_wb) AS ice_wb, avg(crowding) AS crowding, avg(pop_total) AS pop_total
                     FROM long WHERE pop_total <> 0 GROUP BY geoid, ds_pm_pred)
"""


def _tract_values(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")

    def in_year(year, column):
        return F.when(F.year("l_shipdate") == year, column)

    wide = li.groupBy(F.col("l_suppkey").alias("GEOID")).agg(
        F.max("l_tax").alias("ds_pm_pred"),
        F.avg(in_year(1997, F.col("l_discount"))).alias("IC EWBinc 2017"),
        F.avg(in_year(1998, F.col("l_discount"))).alias("IC EWBinc 2018"),
        F.max(in_year(1997, F.col("l_quantity"))).alias("Crowding 2017"),
        F.max(in_year(1998, F.col("l_quantity"))).alias("Crowding 2018"),
        F.sum(F.coalesce(in_year(1997, (F.col("l_returnflag") == "R").cast("int")), F.lit(0))).alias("Pop Total 2017"),
        F.sum(F.coalesce(in_year(1998, (F.col("l_returnflag") == "A").cast("int")), F.lit(0))).alias("Pop Total 2018"),
    )
    fix = {"ic_ewbinc_2017": "ice_wb_2017", "ic_ewbinc_2018": "ice_wb_2018"}
    return fe.two_period_mean(wide, ["geoid", "ds_pm_pred"], [2017, 2018], rename=fix)


@query(
    "two_period_mean",
    "WITH "
    + _TRACT_YEARS
    + "SELECT geoid, ds_pm_pred, round(ice_wb, 9) AS ice_wb, crowding, pop_total FROM tract_values",
)
def two_period_mean(spark, sf_dir):
    return _tract_values(spark, sf_dir).withColumn("ice_wb", F.round("ice_wb", 9))


_DENSITY_INPUT = (
    _TRACT_YEARS
    + """,
    own AS (SELECT c_mktsegment AS grouping_var, 1.0e0 AS weight_tract, ice_wb, crowding, pop_total
            FROM customer JOIN orders ON o_custkey = c_custkey
            JOIN tract_values ON geoid = o_orderkey % (SELECT count(*) FROM supplier) WHERE ice_wb IS NOT NULL),
    both_rows AS (SELECT * FROM own UNION ALL
                  SELECT 'NY Overall', CAST(pop_total AS DOUBLE), ice_wb, crowding, pop_total FROM tract_values),
    tidy AS (UNPIVOT (SELECT grouping_var, weight_tract, ice_wb, crowding, CAST(pop_total AS DOUBLE) AS pop_total FROM both_rows)
             ON ice_wb, crowding, pop_total INTO NAME variable VALUE value)
"""
)


def _density_rows(spark, sf_dir):
    tracts = _tract_values(spark, sf_dir)
    suppliers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
    geography = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("cust_id"), (F.col("o_orderkey") % suppliers).alias("geoid")
    )
    located = geography.join(tracts, "geoid").select("cust_id", "ice_wb", "crowding", "pop_total")
    members = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("ltc_cat_simple")
    )
    return de.density_input(members, located, tracts, ["ice_wb", "crowding", "pop_total"])


@query(
    "density_input",
    "WITH " + _DENSITY_INPUT + "SELECT grouping_var, weight_tract, variable, round(value, 9) AS value FROM tidy",
)
def density_input(spark, sf_dir):
    rows = _density_rows(spark, sf_dir).withColumn("value", F.round("value", 9))
    return rows.where(F.col("value").isNotNull())


def _density_sql(rows: str, n: int) -> str:
    return f"""
    {rows},
    st AS (SELECT variable, grp, count(*) AS n, coalesce(stddev_samp(value), 0) AS sd, min(value) AS lowest,
                  (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34e0 AS iqr FROM r GROUP BY ALL),
    bw AS (SELECT variable, grp, 0.9e0 * pow(CAST(n AS DOUBLE), -0.2e0) * CASE WHEN least(sd, iqr) > 0 THEN least(sd, iqr) WHEN sd > 0 THEN sd
                  WHEN abs(lowest) > 0 THEN abs(lowest) ELSE 1 END AS bw FROM st),
    rng AS (SELECT variable, min(value) AS lo, (max(value) - min(value)) / {n - 1}e0 AS step FROM r GROUP BY 1),
    pos AS (SELECT r.variable, grp, w, CASE WHEN step = 0 THEN 0e0 ELSE (value - lo) / step END AS p FROM r JOIN rng USING (variable)),
    cut AS (SELECT variable, grp, w, p, least(CAST(floor(p) AS INT), {n - 1}) AS b FROM pos),
    bins AS (SELECT variable, grp, b, sum(w) AS w FROM (
                SELECT variable, grp, b, w * (1 - (p - b)) AS w FROM cut
                UNION ALL SELECT variable, grp, least(b + 1, {n - 1}), w * (p - b) FROM cut) GROUP BY ALL),
    tot AS (SELECT variable, grp, sum(w) AS total FROM bins GROUP BY ALL)
    SELECT variable, grp AS grouping_var, CAST(point AS INT) AS point, round(any_value(lo + point * step), 6) AS x,
           round(sum(bins.w * exp(-0.5e0 * pow((point - b) * step / bw, 2))) / any_value(total * bw * sqrt(2e0 * pi())), 6) AS density
    FROM bins JOIN bw USING (variable, grp) JOIN rng USING (variable) JOIN tot USING (variable, grp), range(0, {n}) t(point)
    WHERE total > 0 GROUP BY variable, grp, point
    """


GRID = 512


def _rounded(df):
    return df.withColumns({"x": F.round("x", 6), "density": F.round("density", 6)})


@query(
    "weighted_density",
    "WITH "
    + _density_sql(
        """
    r AS (SELECT 'price' AS variable, l_returnflag AS grp, l_extendedprice / 1000 AS value, l_quantity AS w FROM lineitem
          UNION ALL SELECT 'discount', l_returnflag, l_discount * 100, l_quantity FROM lineitem)
    """,
        GRID,
    ),
)
def weighted_density(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("grouping_var"),
        F.col("l_quantity").alias("weight_tract"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        (F.col("l_discount") * 100).alias("discount"),
    )
    tidy = rows.unpivot(["grouping_var", "weight_tract"], ["price", "discount"], "variable", "value")
    return _rounded(de.weighted_density(tidy, n=GRID))


@query(
    "tract_density",
    "WITH "
    + _density_sql(_DENSITY_INPUT + ", r AS (SELECT variable, grouping_var AS grp, value, weight_tract AS w FROM tidy)", GRID),
)
def tract_density(spark, sf_dir):
    return _rounded(de.weighted_density(_density_rows(spark, sf_dir), n=GRID))


@query(
    "exact_quantiles",
    """
    SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 6) AS q0, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
           round(quantile_cont(l_extendedprice, 0.75), 6) AS q2 FROM lineitem GROUP BY 1
    """,
)
def exact_quantiles(spark, sf_dir):
    df = de.exact_quantiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.25, 0.75])
    return df.withColumns({c: F.round(c, 6) for c in ("q0", "q1", "q2")})
