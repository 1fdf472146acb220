import re

import pytest
from pyspark.sql import functions as F

from linkscore.operators import capacity as K
from linkscore.operators import customers as L
from linkscore.operators import sieve as V

KEY = ["sn", "imsi"]


@pytest.fixture(scope="module")
def rows(spark):
    ids = spark.range(20_000).select(F.format_string("s%05d", "id").alias("sn"), F.col("id").alias("imsi"), F.lit(1).alias("x"))
    none = spark.createDataFrame([(None, 1, 1), ("s00001", None, 1), ("", 0, 1)], "sn string, imsi long, x int")
    return ids.union(none).cache()


def test_all_known_keys_and_few_others_pass(spark, rows):
    known = rows.where(F.col("imsi") % 10 == 0)
    sieve = V.known_keys(known.union(known), KEY)
    found = V.passing(rows, sieve, KEY)
    assert found.columns == rows.columns
    assert known.dropna().exceptAll(found).count() == 0
    assert found.count() < 2_001 + 0.03 * 18_000
    assert sieve.bits.count() <= sieve.words <= 1_024


def test_no_keys_let_nothing_pass_and_too_many_give_no_filter(spark, rows):
    assert V.passing(rows, V.known_keys(rows.limit(0), KEY), KEY).count() == 0
    assert V.passing(rows.limit(0), V.known_keys(rows, KEY), KEY).count() == 0
    assert V.known_keys(rows, KEY, max_words=1_024) is None
    assert V.passing(rows, None, KEY) is rows
    # Between the usual and half the bits per key the filter is denser, and still lets all keys pass.
    dense = V.known_keys(rows, KEY, max_words=4_096)
    assert dense.words == 4_096 and V.passing(rows, dense, KEY).count() == rows.dropna().count()


def test_keys_of_other_types_are_refused(rows):
    with pytest.raises(ValueError):
        V.passing(rows, V.known_keys(rows.withColumn("imsi", F.col("imsi").cast("string")), KEY), KEY)


def test_unknown_devices_leave_before_the_shuffle(inputs):
    i = inputs
    lines = L.customer_line(i.cust, i.sn_map)
    some = lines.where(F.pmod(F.xxhash64("sn"), F.lit(4)) == 0)
    plain, sieved = (K.link_capacity(i.hb, some, known_only=k) for k in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, sieved.collect()))
    plan = sieved._jdf.queryExecution().executedPlan().toString()
    below = plan[re.search(r"Exchange hashpartitioning\(sn#\d+, imsi#\d+", plan).start() :]
    assert "LeftSemi" in plan and "BroadcastHashJoin" in below
    devices = [x.select(KEY).distinct().count() for x in (i.hb, i.hb.join(some, KEY, "left_semi"), V.passing(i.hb, V.known_keys(some, KEY), KEY))]
    assert devices[1] <= devices[2] <= devices[1] + 0.05 * devices[0] < devices[0]
