"""Loan tables derived from the given tables, as described in FIXTURES.md.

The same SQL text runs in Spark and in the SQL oracle. Names in braces are the given tables. A derived
table has one row per row of its source; members that should not match get an id no other table has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

def _alone(key: str, table: int) -> str:
    """An id of its own: the key behind an offset that only this table uses."""
    return f"cast(cast({key} as bigint) + {table}0000000000 as string)"


# Customers with an even number pay, those with an odd one borrow: each side of the joins is large for half of the members, so
# nearly all payments and loans find their member while the combinations of both stay few. A few payments and loans go the
# other way, so that every member has some.
_PAYS = """cast(case when l_linenumber = 1 and l_orderkey % 4 in (1, 2) then o_custkey - 1 + o_custkey % 2
    when o_custkey = 1 then 2 else o_custkey - o_custkey % 2 end as string)"""
_BORROWS = """cast(case when o_orderkey % 32 <> 7 then o_custkey - 1 + o_custkey % 2
    when o_custkey = 1 then 2 else o_custkey - o_custkey % 2 end as string)"""

GIVEN = ("region", "nation", "customer", "orders", "lineitem")

RAW = {
    "accounts": """
select cast(c_custkey * 3 as string) acc_id,
  case when c_custkey % 29 = 0 then 'null' else cast(c_custkey as string) end mem_id,
  case when c_custkey % 47 = 0 then null else cast(c_custkey * 10 as string) end loan_id,
  substr('ABCDEFG', cast(c_custkey % 7 + 1 as int), 1) grade,
  concat(substr('ABCDEFG', cast((case when c_custkey % 23 = 0 then c_custkey + 1 else c_custkey end) % 7 + 1 as int), 1),
         cast(c_custkey % 5 + 1 as string)) sub_grade,
  case when c_custkey % 6 = 0 then 'null' else c_mktsegment end emp_title,
  case c_custkey % 9 when 0 then 'n/a' when 1 then '10+ years' when 2 then '< 1 year' when 3 then '1 year'
    when 4 then '3 years' when 5 then null when 6 then 'null' else '9 years' end emp_length,
  case c_custkey % 8 when 0 then 'OWN' when 1 then 'RENT' when 2 then 'MORTGAGE' when 3 then 'ANY' when 4 then 'NONE'
    when 5 then null when 6 then 'Own' else 'MORTGAGE' end home_ownership,
  cast(floor(abs(c_acctbal)) as float) annual_inc,
  case when c_custkey % 2 = 0 then 'Verified' else 'Not Verified' end verification_status,
  case when c_custkey % 19 = 0 then null else cast(floor(abs(c_acctbal) + 100) * 200 as float) end tot_hi_cred_lim,
  case when c_custkey % 12 = 0 then 'Joint App' else 'Individual' end application_type,
  cast(case when c_custkey % 12 = 0 then 5000 else null end as float) annual_inc_joint,
  case when c_custkey % 12 = 0 then 'Verified' else 'null' end verification_status_joint
from {customer}""",
    "customers": """
select cast(c_custkey + 7 as string) cust_id,
  case when c_custkey % 31 = 0 then null when c_custkey % 53 = 0 then 'null' else cast(c_custkey as string) end mem_id,
  c_name fst_name, c_mktsegment lst_name,
  case when c_custkey % 4 = 0 then 'null' else 'TRUE' end prm_status,
  cast(case when c_custkey % 37 = 0 then null else 18 + c_custkey % 60 end as int) age,
  n_name state, r_name country
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "defaulters": """
select cast(c_custkey * 10 as string) loan_id,
  case when c_custkey % 43 = 0 then null else cast(c_custkey as string) end mem_id,
  case when c_custkey % 41 = 0 then 'null' else cast(c_custkey * 2 as string) end def_id,
  cast(c_custkey % 7 as int) delinq_2yrs, cast(c_custkey % 100 as float) delinq_amnt,
  cast(c_custkey % 4 as int) pub_rec, cast(c_custkey % 3 as int) pub_rec_bankruptcies,
  cast(case when c_custkey % 8 = 7 then null else c_custkey % 8 end as int) inq_last_6mths,
  cast(c_custkey % 50 as float) total_rec_late_fee,
  case c_custkey % 10 when 0 then 'Y' when 1 then 'null' else 'N' end hardship_flag,
  case when c_custkey % 10 = 0 then 'INTEREST ONLY' else 'null' end hardship_type,
  cast(case when c_custkey % 10 = 0 then 3 else null end as int) hardship_length,
  cast(case when c_custkey % 10 = 0 then 250 else null end as float) hardship_amount
from {customer}""",
    "investors": """
select cast(o_orderkey * 3 + 1 as string) investor_loan_id, cast(o_orderkey as string) loan_id,
  case when o_orderkey % 43 = 0 then null when o_orderkey % 47 = 0 then 'null' else cast(o_custkey as string) end investor_id,
  cast(floor(o_totalprice) as float) loan_funded_amount,
  case when o_orderkey % 5 = 0 then 'null' else o_orderpriority end investor_type,
  cast(20 + o_orderkey % 50 as int) age, o_orderstatus state, 'US' country
from {orders}""",
    "loans": f"""
select cast(o_orderkey as string) loan_id,
  case when o_orderkey % 37 = 0 then null else {_BORROWS} end mem_id,
  case when o_orderkey % 41 = 0 then 'null' else cast(o_custkey * 3 as string) end acc_id,
  o_totalprice loan_amt, cast(floor(o_totalprice) as double) fnd_amt,
  case o_orderkey % 3 when 0 then ' 36 months' when 1 then '60 months' else null end term,
  concat(cast(o_orderkey % 25 as string), '.5%') interest,
  cast(floor(o_totalprice / 36) as float) installment, cast(o_orderdate as date) issue_date,
  case when o_orderkey % 9 = 0 then 'null' else 'Current' end loan_status, o_orderpriority purpose,
  case when o_orderkey % 14 = 0 then 'null' else 'Debt' end title, 'Cash' disbursement_method
from {{orders}}""",
    "payments": f"""
select cast(l_orderkey as string) loan_id,
  case when l_partkey % 31 = 0 then 'null' when o_custkey % 23 = 0 then {_alone("o_custkey", 1)} else {_PAYS} end mem_id,
  case when l_partkey % 37 = 0 then null
    else concat(cast(l_orderkey as string), 'x', cast(l_partkey as string)) end latest_transaction_id,
  l_extendedprice funded_amnt_inv, cast(floor(l_extendedprice * 0.5) as float) total_pymnt_rec,
  cast(l_quantity as float) installment,
  cast(case when l_suppkey % 6 = 5 then null else l_quantity * 0.5 end as float) last_pymnt_amnt,
  cast(l_shipdate as date) last_pymnt_d,
  case when l_partkey % 9 = 0 then null else cast(o_orderdate as date) end next_pymnt_d,
  case when l_partkey % 8 = 0 then 'null' else 'ACH' end pymnt_method
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
}

_INCIDENTS = """case {n} % 16 when 15 then null when 14 then -1 when 8 then 1 when 9 then 2 when 10 then 3
    when 11 then 4 when 12 then 5 when 13 then 6 else 0 end"""

CLEANED = {
    "customers": f"""
select case when c_custkey % 29 = 0 then {_alone("c_custkey", 2)} else cast(c_custkey as string) end member_id,
  c_name first_name, c_mktsegment last_name, n_name state, r_name country
from {{customer}} join {{nation}} on c_nationkey = n_nationkey join {{region}} on n_regionkey = r_regionkey""",
    "payments": f"""
select case when o_custkey % 23 = 0 then {_alone("o_custkey", 3)} else {_PAYS} end member_id,
  l_extendedprice funded_amount_investor,
  case when l_partkey % 7 = 0 then null when l_partkey % 7 = 1 then cast(0 as float)
    when l_partkey % 7 = 2 then cast(-1 as float)
    else cast(l_extendedprice * (l_partkey % 7) * 0.125 as float) end total_payment_recorded,
  cast(l_quantity as float) installment,
  case when l_suppkey % 6 = 5 then null when l_suppkey % 6 = 4 then cast(l_quantity as float)
    else cast(l_quantity * (l_suppkey % 6 + 1) * 0.4375 as float) end last_payment_amount
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "defaulters": f"""
select case when c_custkey % 40 in (13, 24) then {_alone("c_custkey", 4)} else cast(c_custkey as string) end member_id,
  {_INCIDENTS.format(n="c_custkey")} defaulters_2yrs,
  {_INCIDENTS.format(n="(c_custkey * 5 + 2)")} public_records,
  {_INCIDENTS.format(n="(c_custkey * 7 + 1)")} public_records_bankruptcies,
  {_INCIDENTS.format(n="(c_custkey * 3 + 5)")} enquiries_6mnths,
  case c_custkey % 10 when 0 then 'Y' when 1 then null when 2 then 'U' else 'N' end hardship_flag
from {{customer}}""",
    "loans": f"""
select case when o_orderkey % 29 = 0 then {_alone("o_custkey", 5)} else {_BORROWS} end member_id,
  o_totalprice funded_amount,
  case o_orderkey % 9 when 0 then 'Fully Paid' when 1 then 'Current' when 2 then 'In Grace Period'
    when 3 then 'Late (16-30 days)' when 4 then 'Late (31-120 days)' when 5 then 'Charged Off' when 6 then 'Default'
    when 7 then null else 'Does not meet the credit policy. Status:Fully Paid' end loan_status
from {{orders}}""",
    "accounts": f"""
select case when c_custkey % 17 = 0 then {_alone("c_custkey", 6)} else cast(c_custkey as string) end member_id,
  substr('ABCDEFG', cast(c_custkey % 7 + 1 as int), 1) grade,
  concat(substr('ABCDEFG', cast((case when c_custkey % 23 = 0 then c_custkey + 1 else c_custkey end) % 7 + 1 as int), 1),
         cast(c_custkey % 5 + 1 as string)) sub_grade,
  case c_custkey % 8 when 0 then 'OWN' when 1 then 'RENT' when 2 then 'MORTGAGE' when 3 then 'ANY' when 4 then 'NONE'
    when 5 then null when 6 then 'Own' else 'MORTGAGE' end home_ownership,
  case when c_custkey % 19 = 0 then null else cast((abs(c_acctbal) + 100) * 200 as float) end total_high_credit_limit
from {{customer}}""",
}

# Member 4 has a third of all payments, member 2 many payments and many loans, whose product is large.
# A third of the defaulter rows have no member id.
HOT = {
    "customers": CLEANED["customers"],
    "payments": f"""
select case when cast(member_id as bigint) % 3 = 0 then '4' when cast(member_id as bigint) % 100 = 1 then '2'
    else member_id end member_id,
  funded_amount_investor, total_payment_recorded, installment, last_payment_amount
from ({CLEANED["payments"]}) p""",
    "defaulters": f"""
select case when cast(member_id as bigint) % 3 = 0 then null else member_id end member_id,
  defaulters_2yrs, public_records, public_records_bankruptcies, enquiries_6mnths, hardship_flag
from ({CLEANED["defaulters"]}) d""",
    "loans": f"""
select case when cast(member_id as bigint) % 400 = 1 then '2' else member_id end member_id, funded_amount, loan_status
from ({CLEANED["loans"]}) l""",
    "accounts": f"""
select case when member_id in ('300', '600', '900') then '4' else member_id end member_id,
  grade, sub_grade, home_ownership, total_high_credit_limit
from ({CLEANED["accounts"]}) a""",
}


_schemas: dict[str, StructType] = {}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; its schema is looked up in the file once per process."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run fixture SQL over the given tables."""
    used = [t for t in GIVEN if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: given(spark, sf_dir, t) for t in used})


def as_oracle(sql: str) -> str:
    """Fixture SQL with plain table names."""
    return sql.format(**{t: t for t in GIVEN})
