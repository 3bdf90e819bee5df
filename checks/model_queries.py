"""Queries over training data and models."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.feature_queries import features, profiles, tidy
from checks.registry import query
from checks.scoring_queries import BASE, LABEL_AS_OF, LABELS, labelled
from checks.views import exprs, sql
from holdfast.functions.neighbours import nearest_neighbours
from holdfast.operators import customer, models, prepare
from holdfast.plans import features as plan
from holdfast.plans import daily, training
from holdfast.session import pinned, scratch_path
from holdfast.sources import fixtures as fx
from holdfast.sources import scans


def _split(rows: str) -> str:
    """Rows with their split: shares of each class in the order of a hash."""
    u = "CAST('0x'||substr(md5('42-'||CAST(customer_id AS VARCHAR)),1,8) AS BIGINT)"
    place = f"row_number() OVER (PARTITION BY churned ORDER BY {u}, customer_id)"
    n = "count(*) OVER (PARTITION BY churned)"
    return (
        f"SELECT *, CASE WHEN {place} <= 0.2::DOUBLE * {n} THEN 'test' WHEN {place} <= {0.2 + 0.1!r}::DOUBLE * {n} "
        f"THEN 'validation' ELSE 'train' END AS split FROM ({rows})"
    )


@query(sql(_split(LABELS), BASE))
def train_test_split(spark, folder):
    return prepare.train_test_split(labelled(spark, folder))


@query(sql(
    f"""
SELECT CAST(place % 5 AS INT) AS fold, count(*) AS rows, CAST(sum(churned) AS BIGINT) AS positives FROM (
  SELECT churned, row_number() OVER (PARTITION BY churned ORDER BY
    CAST('0x'||substr(md5('fold-42-'||CAST(customer_id AS VARCHAR)),1,8) AS BIGINT), customer_id) - 1 AS place FROM ({LABELS})) GROUP BY 1""",
    BASE,
))
def cv_fold_balance(spark, folder):
    return prepare.fold_balance(prepare.with_folds(labelled(spark, folder)))


@query(sql(
    f"""
SELECT churned, count(*) AS rows, sum(count(*)) OVER ()/(count(*) OVER () * count(*)) AS balanced_weight,
  CAST(CASE churned WHEN 1 THEN 3 ELSE 1 END AS DOUBLE) AS boosting_weight FROM ({LABELS}) GROUP BY 1""",
    BASE,
))
def class_weights(spark, folder):
    return prepare.class_weights(labelled(spark, folder))


_CATEGORICAL = (
    "account_status", "customer_tier", "country", "gender", "referral_source", "subscription_type",
    "customer_lifecycle_stage", "age_group",
)


@query(sql(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", coalesce({c}, 'unknown') AS level, count(*) AS rows FROM staged GROUP BY 1, 2"""
        for c in _CATEGORICAL
    ),
    ("customers",),
    {"staged": f"SELECT *, {exprs(v.TEMPORAL)}, {v.AGE_GROUP} AS age_group FROM customers"},
))
def one_hot_levels(spark, folder):
    staged = customer.demographic_features(customer.temporal_features(profiles(spark, folder)))
    return prepare.one_hot_levels(staged.na.fill("unknown", list(prepare.CATEGORICAL)))


@query("""
SELECT a.vec_id AS id, b.vec_id AS neighbour_id,
  round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS distance,
  CAST(row_number() OVER (PARTITION BY a.vec_id
    ORDER BY list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), b.vec_id) AS INT) AS rank
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
QUALIFY rank <= 5""")
def minority_knn(spark, folder):
    """Every class in turn as the minority: five nearest vectors of the same label."""
    points = fx.table(spark, folder, "embeddings").select(
        F.col("label").alias("group"), F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    return tidy(nearest_neighbours(points, 5), {"distance"}, 6)


# ---------------------------------------------------------------- models (small ones, whose real values have no SQL: see tests/test_models.py)

def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Training table at the label time: customers known by then."""
    tables = fx.all_tables(spark, folder)
    known = training.known_profiles(tables["customers"], LABEL_AS_OF)
    own = scans.scan_customer_profiles(known, LABEL_AS_OF, None, None)
    wide = plan.build_features(own, tables, LABEL_AS_OF, fx.EVENTS_AS_OF)
    return training.training_table(wide, known, tables["transactions"], LABEL_AS_OF)


# labels of the customers registered before the label time
KNOWN = f"SELECT l.* FROM ({LABELS}) l JOIN customers k USING (customer_id) WHERE k.registration_date < CAST({v.LABEL} AS DATE)"


@query(sql(
    f"""
SELECT s.customer_id, s.churned, s.split, CAST(CAST({v.LABEL} AS DATE) - k.registration_date AS INT) AS customer_age_days,
  CASE WHEN k.last_login_date < CAST({v.LABEL} AS DATE) THEN CAST(CAST({v.LABEL} AS DATE) - k.last_login_date AS INT) END AS days_since_last_login
FROM ({_split(KNOWN)}) s JOIN customers k USING (customer_id)""",
    BASE,
))
def training_population(spark, folder):
    return training_rows(spark, folder).select("customer_id", "churned", "split", "customer_age_days", "days_since_last_login")


def encoded_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    encoded, _, _ = training.encode(training_rows(spark, folder))
    names = models.feature_names(encoded)
    return pinned(encoded, "encoded"), names


# the new rows themselves have no SQL equivalent; their number has
@query(sql(
    """
SELECT churned, false AS synthetic, count(*) AS rows FROM train GROUP BY 1
UNION ALL SELECT CAST(1 AS INT), true, CAST(count(*) FILTER (churned=0)//2 - count(*) FILTER (churned=1) AS BIGINT) FROM train""",
    BASE,
    {"train": f"SELECT churned FROM ({_split(KNOWN)}) WHERE split = 'train'"},
))
def smote_oversample(spark, folder):
    encoded, _ = encoded_rows(spark, folder)
    balanced = prepare.smote_oversample(encoded.where(F.col("split") == "train"))
    return balanced.groupBy("churned", F.col("customer_id").isNull().alias("synthetic")).agg(F.count("*").alias("rows"))


@query()
def train_random_forest(spark, folder):
    """A forest of ``models.Settings()`` (200 trees of depth 15): the probability of every customer, all splits.

    With two checks for every row: its probability is one, and a second fit gives the same.
    """
    encoded, _ = encoded_rows(spark, folder)
    train, p = encoded.where(F.col("split") == "train"), F.col("forest_probability")
    scored = models.model_probability(models.train_random_forest(train, models.Settings()), encoded, "forest_probability")
    scored = models.model_probability(models.train_random_forest(train, models.Settings()), scored, "again")
    return scored.select(
        "customer_id", "split", "churned", p, p.between(0, 1).alias("in_range"), (p == F.col("again")).alias("same_when_refitted")
    )


@query()
def train_gbt(spark, folder):
    """Spark's own boosted trees at ``models.SMALL``: the probability of every customer, all splits."""
    encoded, _ = encoded_rows(spark, folder)
    fitted = models.train_gbt(encoded.where(F.col("split") == "train"), models.SMALL)
    return models.model_probability(fitted, encoded, "gbt_probability").select("customer_id", "split", "churned", "gbt_probability")


@query()
def train_boosting(spark, folder):
    """Regularised boosting at ``models.SMALL`` (10 rounds of depth 4): the probability of every customer, all splits."""
    encoded, _ = encoded_rows(spark, folder)
    fitted = models.train_boosting(encoded.where(F.col("split") == "train"), models.SMALL)
    scored = models.model_probability(fitted, encoded, "boosting_probability")
    return scored.select("customer_id", "split", "churned", "boosting_probability")


def _both(spark, folder):
    encoded, names = encoded_rows(spark, folder)
    train = pinned(prepare.smote_oversample(encoded.where(F.col("split") == "train")), "balanced")
    forest = models.train_random_forest(train, models.SMALL)
    return encoded, names, forest, models.train_boosting(train, models.SMALL)


@query()
def ensemble_score(spark, folder):
    """Both probabilities and their blend for every customer, by models of ``models.SMALL`` (20 trees of depth 5, 10 rounds of depth 4)."""
    encoded, _, forest, boosting = _both(spark, folder)
    scored = models.ensemble_score(forest, boosting, encoded, models.SMALL)
    return scored.select("customer_id", "split", "churned", "forest_probability", "boosting_probability", "churn_probability")


@query()
def feature_importance(spark, folder):
    """The importances of both models of ``models.SMALL`` and their blend, one row a feature."""
    encoded, names, forest, boosting = _both(spark, folder)
    return models.feature_importance(forest, boosting, names, encoded, models.SMALL)


@query()
def cross_validate(spark, folder):
    """Per model of ``models.SMALL``: five areas, their mean and deviation."""
    encoded, _ = encoded_rows(spark, folder)
    return models.cross_validate(encoded.where(F.col("split") == "train"), models.SMALL)


@query()
def train_pipeline(spark, folder):
    """The metrics of the whole job at ``models.SMALL``, and the mean area of each model over five folds."""
    done = training.train_pipeline(training_rows(spark, folder), models.SMALL, scratch_path(spark, "models"))
    validated = done.cross_validation.select(F.col("model").alias("dataset"), F.lit("cross_validation").alias("metric"), F.col("auc_mean").alias("value"))
    return done.metrics.unionByName(validated)


@query()
def daily_run(spark, folder):
    """Train models of ``models.SMALL``, save, load, score all customers at the later as-of time, report and queue campaigns.

    Cross-validation is left to the training job. Per customer: the probability and its band.
    """
    path, moment = scratch_path(spark, "daily"), datetime(2001, 8, 2)
    training.train_pipeline(training_rows(spark, folder), models.SMALL, f"{path}/models", gate=0.0, folds=0)
    scorer = training.Scorer.load(spark, f"{path}/models")
    scored = daily.scoring_run(features(spark, folder), scorer, path, moment, models.SMALL)
    daily.campaign_run(spark, path, moment)
    return scored.select("customer_id", "churn_probability", "risk_category")
