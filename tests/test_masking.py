from __future__ import annotations

import hashlib

import pytest
from plans import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayer.functions.masking import mask_email, mask_ip, register_sql_functions

IP_CASES = {
    "192.168.1.1": "192.x.x.x",
    "a.b.c.d": "a.x.x.x",
    "1.2.3": "x.x.x.x",
    "::1": "x.x.x.x",
    "": "x.x.x.x",
    "1.2.3.4.5": "x.x.x.x",
    ".1.2.3": ".x.x.x",
    "1.2.3.": "1.x.x.x",
    "...": ".x.x.x",
    None: None,
}


def ip_rule(ip):
    """The rule in plain Python, as a second opinion."""
    if ip is None:
        return None
    first, *others = ip.split(".")
    return first + ".x.x.x" if len(others) == 3 else "x.x.x.x"


def email_rule(email):
    return None if email is None else hashlib.sha256(email.encode()).hexdigest()


def masked(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", mask_ip("v").alias("ip"), mask_email("v").alias("mail"))
    return {row.v: (row.ip, row.mail) for row in rows.collect()}


def test_ip_edge_cases(spark):
    result = masked(spark, IP_CASES)
    assert {ip: result[ip][0] for ip in IP_CASES} == IP_CASES
    assert {ip: ip_rule(ip) for ip in IP_CASES} == IP_CASES


def test_email_is_hashed_as_it_is(spark):
    result = masked(spark, ["a@b.c", "A@b.c", " a@b.c", "ü@b.c", None])
    known = "d648b243a3e817eaa3309e00e183483f2867baadf522099f0c2121770536b25a"
    assert result["a@b.c"][1] == known
    assert len({mail for _, mail in result.values()}) == 5
    assert {v: mail for v, (_, mail) in result.items()} == {
        v: email_rule(v) for v in result
    }


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.text(alphabet=".:0123456789abcé \n\\", max_size=12), min_size=20))
def test_masks_agree_with_plain_rule(spark, values):
    result = masked(spark, values)
    for value in values:
        assert result[value] == (ip_rule(value), email_rule(value))


def test_masks_need_no_python_worker(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("v"))
    plan = plan_of(df.select(mask_ip("v"), mask_email("v")))
    assert "Python" not in plan


@pytest.mark.parametrize("value", list(IP_CASES))
def test_sql_functions_agree(spark, value):
    register_sql_functions(spark)
    row = spark.sql(
        "select mask_ip(:v) as ip, mask_email(:v) as mail", {"v": value}
    ).first()
    assert (row.ip, row.mail) == (ip_rule(value), email_rule(value))
