"""Unique checks: every column on its own table, whole values compared."""

from __future__ import annotations

import __spark_entry__ as entry
from ordermart.functions import core as fn
from ordermart.operators import quality
from ordermart.plans import catalog
from ordermart.plans.models import Models
from tests.conftest import SF_SMALL


def test_unique_keys_of_the_fact_are_checked_on_the_fact(spark, monkeypatch):
    """not taken over from the lines it is made of."""
    tables = Models.check_tables

    def doubled(self):
        found = tables(self)
        return found | {"fact_orders": found["fact_orders"].unionAll(found["fact_orders"])}

    monkeypatch.setattr(Models, "check_tables", doubled)
    got = {r.check_name: r.failures for r in entry.queries()["dq_unique"](spark, SF_SMALL).collect()}
    assert got["unique__int_orders_enriched__order_line_sk"] == 0
    assert got["unique__fact_orders__order_line_sk"] == catalog._m(spark, SF_SMALL).fact.count() > 0
    assert len(got) == len(quality.checks_of("unique"))


def test_whole_values_are_compared_in_short_form(spark):
    """texts that are alike in part, or hex digits of another form, are told apart."""
    texts = ["", "0", "00", "ab", "AB", "aB", "abc", "0abc", "a" * 32, "a" * 34, "é", "zz", "-1", None]
    t = spark.createDataFrame([(x,) for x in texts], "s string")
    forms = {tuple(r) for r in t.where("s is not null").select(*fn.short_hex("s")).collect()}
    assert len(forms) == len(texts) - 1
    checks = [quality.Check("t", "s", "unique"), quality.Check("u", "s", "unique")]
    u = t.unionAll(t.where("s in ('AB', 'ab') or s is null"))
    got = {r.check_name: r.failures for r in quality.run_checks({"t": t, "u": u}, checks).collect()}
    assert got == {"unique__t__s": 0, "unique__u__s": 2}
