"""Masking in SQL, and distinct ids from sketches."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.plans import roles, sketches


def test_the_view_follows_the_role(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a.b@c.de"), (2, None), (3, "no address")], "id int, mail string").write.parquet(path)
    roles.register_masking(spark, ("ANALYST_ROLE", "GUEST"))
    roles.masked_view(spark, "letters", path, ["id", "mail"], ["mail"])
    seen = {}
    for role in (None, "ANALYST_ROLE", "GUEST", "ADMIN"):
        roles.set_role(spark, role)
        seen[role] = [r.mail for r in spark.sql("SELECT * FROM letters ORDER BY id").collect()]
    hidden = ["***@c.de", None, "no address"]
    assert seen == {None: hidden, "ANALYST_ROLE": hidden, "GUEST": hidden, "ADMIN": ["a.b@c.de", None, "no address"]}
    # Filters see what the role sees.
    roles.set_role(spark, "GUEST")
    assert spark.sql("SELECT * FROM letters WHERE mail LIKE 'a.b%'").count() == 0
    roles.register_masking(spark)
    assert spark.sql("SELECT mail FROM letters WHERE id = 1").first().mail == "***@c.de"
    with pytest.raises(ValueError):
        roles.masked_view(spark, "letters", path, ["id"], ["mail"])
    with pytest.raises(AnalysisException):
        roles.masked_view(spark, "letters", path, ["id", "gone"], ["gone"])


def test_sketches_add_up_over_batches_and_days(spark):
    rows = spark.range(0, 60_000).select(
        (F.col("id") % 20_000).cast("string").alias("id"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id % 10)").alias("created_at"), (F.col("id") % 3).cast("string").alias("batch_id")
    )
    parts = [sketches.day_sketches(rows.where(F.col("batch_id") == b), "s") for b in "012"]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole = sketches.distinct_ids(stored).first()
    assert whole.row_count == 60_000 and abs(whole.unique_ids_estimate - 20_000) <= 0.025 * 20_000
    assert whole.unique_ids_least <= 20_000 <= whole.unique_ids_most
    weeks = {r.week: r.row_count for r in sketches.weekly_ids(stored).collect()}
    assert weeks == {dt.date(2024, 1, 1): 42_000, dt.date(2024, 1, 8): 18_000}


def test_sketches_of_few_null_and_no_ids(spark):
    rows = spark.createDataFrame([("a", "b1"), ("a", "b1"), (None, "b1"), (None, "b2")], "id string, batch_id string").withColumn("created_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    made = sketches.day_sketches(rows, "s")
    assert {r.batch_id: (r.row_count, r.unique_ids) for r in made.collect()} == {"b1": (3, 1), "b2": (1, 0)}
    assert sketches.distinct_ids(made).first().unique_ids_estimate == 1
    none = sketches.distinct_ids(made.where("false")).first()
    assert (none.row_count, none.unique_ids_estimate) == (0, 0)
