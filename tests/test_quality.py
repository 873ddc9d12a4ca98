"""Data-quality rules and the single-pass report."""

from pyspark.sql import functions as F

from haulwise.operators import quality as dq


def test_rule_counts_and_null_semantics(spark):
    df = spark.createDataFrame([("a", "1", "pending"), ("a", "-2", "lost"), (None, None, None), (None, "x", "shipped")],
                               "id string, qty string, status string")
    v = (dq.Validator()
         .add_rule(dq.Rule("nn", "d", mask=dq.not_null("id")))
         .add_rule(dq.Rule("uq", "d", violations=dq.unique_values("id")))
         .add_rule(dq.Rule("neg", "d", mask=dq.non_negative("qty")))
         .add_rule(dq.Rule("rng", "d", mask=dq.between("qty", 0, 0.5)))
         .add_rule(dq.Rule("set", "d", mask=dq.in_set("status", dq.ORDER_STATUSES))))
    got = {r.rule: (r.violation_count, r.passed) for r in v.report(df, "t").collect()}
    # unique counts every member, and NULLs count as equal
    assert got == {"nn": (2, False), "uq": (4, False), "neg": (1, False), "rng": (2, False), "set": (1, False)}


def test_referential_and_orphans(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (9,)], "warehouse_key long")
    dim = spark.createDataFrame([(1,), (2,)], "warehouse_key long")
    rule = dq.Rule("fk", "d", violations=dq.referential_integrity("warehouse_key", dim, "warehouse_key"))
    assert dq.Validator([rule]).counts(fact).first().violation_count == 1
    assert dq.orphan_count(fact, dim).first().orphan_count == 1


def test_summary_counts_orphan_failure(spark):
    rep = spark.createDataFrame([("t", "a", "d", True, 0), ("t", "b", "d", False, 3)], dq.REPORT_SCHEMA)
    orph = spark.createDataFrame([(2,)], "orphan_count long")
    r = dq.quality_summary(rep, orph).first()
    assert (r.total_checks, r.failures) == (2, 2)


def test_samples_follow_landing_order(spark):
    df = spark.createDataFrame([(i, -i) for i in range(10, 0, -1)], "_row_seq long, q long")
    v = dq.Validator([dq.Rule("neg", "d", mask=dq.non_negative("q"))])
    assert [r._row_seq for r in v.samples(df, "neg").collect()] == [1, 2, 3, 4, 5]
    assert F is not None
