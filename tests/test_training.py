"""Training rows must not know what happens at or after the as-of time."""

from pyspark.sql import functions as F

from checks.scoring_queries import LABEL_AS_OF
from holdfast.plans import features as plan
from holdfast.plans import training
from holdfast.sources import fixtures as fx
from holdfast.sources import scans


def rows(tables):
    known = training.known_profiles(tables["customers"], LABEL_AS_OF)
    own = scans.scan_customer_profiles(known, LABEL_AS_OF, None, None)
    wide = plan.build_features(own, tables, LABEL_AS_OF, fx.EVENTS_AS_OF)
    table = training.training_table(wide, known, tables["transactions"], LABEL_AS_OF)
    return table, sorted(map(str, table.drop("churned", "split").collect()))


def test_later_rows_change_no_feature(spark, sf):
    tables = fx.all_tables(spark, sf)
    table, full = rows(tables)
    assert "account_status" not in table.columns
    moment = F.lit(str(LABEL_AS_OF)).cast("timestamp_ntz")
    cut = dict(tables)
    customers = tables["customers"].where(F.col("registration_date") < moment.cast("date"))
    later = F.col("last_login_date") >= moment.cast("date")
    cut["customers"] = customers.withColumn("last_login_date", F.when(~later, F.col("last_login_date"))).withColumn("account_status", F.lit("gone"))
    for name, ts in (("transactions", "transaction_date"), ("subscription_history", "subscription_start_date")):
        cut[name] = tables[name].where(F.col(ts) < moment)
    earlier = tables["transactions"].where(F.col("transaction_date") < moment).select("transaction_id")
    cut["transaction_lines"] = tables["transaction_lines"].join(earlier.distinct(), "transaction_id", "left_semi")
    _, without = rows(cut)
    assert full == without
    first = table.agg(F.min("customer_age_days"), F.min("days_since_last_login")).first()
    assert first[0] > 0 and (first[1] is None or first[1] > 0)
