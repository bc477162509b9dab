"""SQL counterparts of the registered queries, for DuckDB over the given tables.

Written apart from the library: rules are list lookups and ladders over plain numbers here.
"""

from __future__ import annotations

import re

from workload import fixtures
from workload.fixtures import as_oracle

# --- faulty CSV lines -------------------------------------------------------------------------
# Lines are built from these fields; a field expression is SQL text for both engines.

_PAYMENT_FIELDS = {
    "loan_id": "cast(o_orderkey as string)",
    "mem_id": "case when o_orderkey % 4 = 0 then ' ' else '' end || cast(o_custkey as string)",
    "latest_transaction_id": "case o_orderkey % 5 when 0 then '' when 1 then 'T 1' else o_orderpriority end",
    "funded_amnt_inv": "case when o_orderkey % 6 = 0 then 'abc' else cast(cast(floor(o_totalprice) as bigint) as string) end",
    "total_pymnt_rec": "case when o_orderkey % 7 = 0 then '1,5' else cast(o_custkey as string) || '.5' end",
    "installment": "case when o_orderkey % 8 = 0 then '' else cast(o_orderkey % 90 as string) end",
    "last_pymnt_amnt": "case when o_orderkey % 9 = 0 then '12USD' else cast(o_orderkey % 70 as string) end",
    "last_pymnt_d": "case o_orderkey % 10 when 0 then 'Jan-2018' when 1 then '31/12/1998' when 2 then '' else cast(cast(o_orderdate as date) as string) end",
    "next_pymnt_d": "cast(cast(o_orderdate as date) as string)",
    "pymnt_method": "case when o_orderkey % 3 = 0 then 'null' else 'ACH' end",
}
_CUSTOMER_FIELDS = {
    "cust_id": "cast(c_custkey as string)",
    "mem_id": "case when c_custkey % 7 = 0 then '' else cast(c_custkey as string) end",
    "fst_name": "c_name",
    "lst_name": "c_mktsegment || ', jr'",
    "prm_status": "case when c_custkey % 4 = 0 then 'null' else 'TRUE' end",
    "age": "case c_custkey % 9 when 0 then '12x' when 1 then '' when 2 then '99999999999' when 3 then '3.5' else cast(c_custkey % 80 as string) end",
    "state": "case when c_custkey % 5 = 0 then ' NY' else 'CA' end",
    "country": "'US'",
}
_ACCOUNT_FIELDS = {
    "acc_id": "cast(c_custkey as string)",
    "mem_id": "case when c_custkey % 7 = 0 then '' else cast(c_custkey as string) end",
    "loan_id": "case when c_custkey % 6 = 0 then ' L1' else 'L2' end",
    "grade": "'A'",
    "sub_grade": "'A1'",
    "emp_title": "c_mktsegment || ', senior'",
    "emp_length": "case when c_custkey % 5 = 0 then 'n/a' else '9 years' end",
    "home_ownership": "case when c_custkey % 10 = 0 then '' else 'OWN' end",
    "annual_inc": "case when c_custkey % 6 = 0 then 'abc' else cast(c_custkey as string) || '.5' end",
    "verification_status": "'Verified'",
    "tot_hi_cred_lim": "case when c_custkey % 8 = 0 then '1,5' else cast(c_custkey % 900 as string) end",
    "application_type": "'Individual'",
    "annual_inc_joint": "case when c_custkey % 9 = 0 then '12USD' else '' end",
    "verification_status_joint": "'null'",
}
_DEFAULTER_FIELDS = {
    "loan_id": "cast(c_custkey as string)",
    "mem_id": "case when c_custkey % 7 = 0 then ' ' else 'M' end || cast(c_custkey as string)",
    "def_id": "c_mktsegment || ', d'",
    "delinq_2yrs": "case c_custkey % 5 when 0 then 'two' when 1 then '9999999999' else cast(c_custkey % 7 as string) end",
    "delinq_amnt": "case when c_custkey % 6 = 0 then '' else cast(c_custkey % 100 as string) || '.25' end",
    "pub_rec": "case when c_custkey % 4 = 0 then '3.0' else '1' end",
    "pub_rec_bankruptcies": "cast(c_custkey % 3 as string)",
    "inq_last_6mths": "case when c_custkey % 8 = 0 then 'x' else '-1' end",
    "total_rec_late_fee": "case when c_custkey % 9 = 0 then 'abc' else '7' end",
    "hardship_flag": "case when c_custkey % 10 = 0 then '' else 'N' end",
    "hardship_type": "'null'",
    "hardship_length": "case when c_custkey % 2 = 0 then '3' else '' end",
    "hardship_amount": "case when c_custkey % 3 = 0 then '250' else '12USD' end",
}
_INVESTOR_FIELDS = {
    "investor_loan_id": "cast(o_orderkey as string)",
    "loan_id": "case when o_orderkey % 7 = 0 then '' else cast(o_custkey as string) end",
    "investor_id": "case when o_orderkey % 4 = 0 then ' I' else 'I' end",
    "loan_funded_amount": "case when o_orderkey % 6 = 0 then 'abc' else cast(o_custkey as string) || '.5' end",
    "investor_type": "o_orderpriority || ', x'",
    "age": "case o_orderkey % 9 when 0 then '12x' when 1 then '' when 2 then '99999999999' else cast(o_orderkey % 80 as string) end",
    "state": "o_orderstatus",
    "country": "case when o_orderkey % 5 = 0 then '' else 'US' end",
}
_LOAN_FIELDS = {
    "loan_id": "cast(o_orderkey as string)",
    "mem_id": "case when o_orderkey % 7 = 0 then '' else cast(o_custkey as string) end",
    "acc_id": "case when o_orderkey % 4 = 0 then ' A' else 'A' end",
    "loan_amt": "case when o_orderkey % 6 = 0 then 'abc' else cast(o_custkey as string) || '.5' end",
    "fnd_amt": "case when o_orderkey % 8 = 0 then '1,5' else cast(o_orderkey % 900 as string) end",
    "term": "case when o_orderkey % 3 = 0 then ' 36 months' else '60 months' end",
    "interest": "cast(o_orderkey % 25 as string) || '.5%'",
    "installment": "case when o_orderkey % 9 = 0 then '' else cast(o_orderkey % 90 as string) end",
    "issue_date": "case o_orderkey % 10 when 0 then 'Jan-2018' when 1 then '31/12/1998' when 2 then '' else cast(cast(o_orderdate as date) as string) end",
    "loan_status": "'Current'",
    "purpose": "o_orderpriority",
    "title": "'Debt'",
    "disbursement_method": "case when o_orderkey % 5 = 0 then 'null' else 'Cash' end",
}


def _line(fields: dict[str, str], quoted: tuple[str, ...], short: str, long: str) -> str:
    """All fields of a row joined to a line; some rows end early or carry one field more."""
    parts = [f"'\"' || {sql} || '\"'" if name in quoted else sql for name, sql in fields.items()]
    whole = " || ',' || ".join(f"({p})" for p in parts)
    start = " || ',' || ".join(f"({p})" for p in parts[:4])
    return f"case when {short} then {start} when {long} then {whole} || ',surplus' else {whole} end"


# Fields, quoted ones, key whose multiples of 11 are short and of 13 long, source, types other than text.
_FAULTY = {
    "payments": (
        _PAYMENT_FIELDS, ("latest_transaction_id", "total_pymnt_rec"), "o_orderkey", "orders",
        {"funded_amnt_inv": "double", "last_pymnt_d": "date", "next_pymnt_d": "date",
         **dict.fromkeys(("total_pymnt_rec", "installment", "last_pymnt_amnt"), "float")},
    ),
    "customers": (_CUSTOMER_FIELDS, ("lst_name",), "c_custkey", "customer", {"age": "integer"}),
    "accounts": (
        _ACCOUNT_FIELDS, ("emp_title", "tot_hi_cred_lim"), "c_custkey", "customer",
        dict.fromkeys(("annual_inc", "tot_hi_cred_lim", "annual_inc_joint"), "float"),
    ),
    "defaulters": (
        _DEFAULTER_FIELDS, ("def_id",), "c_custkey", "customer",
        {**dict.fromkeys(("delinq_2yrs", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths", "hardship_length"), "integer"),
         **dict.fromkeys(("delinq_amnt", "total_rec_late_fee", "hardship_amount"), "float")},
    ),
    "investors": (
        _INVESTOR_FIELDS, ("investor_type",), "o_orderkey", "orders", {"loan_funded_amount": "float", "age": "integer"},
    ),
    "loans": (
        _LOAN_FIELDS, ("fnd_amt",), "o_orderkey", "orders",
        {"loan_amt": "double", "fnd_amt": "double", "installment": "float", "issue_date": "date"},
    ),
}
FAULTY_LINES = {
    name: f"select {_line(fields, quoted, f'{key} % 11 = 0', f'{key} % 13 = 0')} line from {{{source}}}"
    for name, (fields, quoted, key, source, _) in _FAULTY.items()
}


_REPARSED_DATE = """case o_orderkey % 10 when 0 then '2018-01-01' when 1 then '1998-12-31' when 2 then ''
  else cast(cast(o_orderdate as date) as string) end"""


def _parsed(fields: dict[str, str], types: dict[str, str], short: str, source: str) -> str:
    out = []
    for i, (name, sql) in enumerate(fields.items()):
        value = f"nullif({sql}, '')"
        if name in types:
            value = f"try_cast({value} as {types[name]})"
            if types[name] == "integer":
                value = f"case when regexp_full_match({sql}, '-?[0-9]+') then {value} end"
        out.append(f"case when {short} then null else {value} end {name}" if i > 3 else f"{value} {name}")
    return f"select {', '.join(out)} from {source}"


# --- cleaning ---------------------------------------------------------------------------------

_RAW = {name: as_oracle(sql) for name, sql in fixtures.RAW.items()}
_N = "nullif({0}, 'null')".format

CLEAN = {
    "accounts": f"""
select sha256({_N('acc_id')} || {_N('mem_id')} || {_N('loan_id')}) account_key,
  {_N('acc_id')} account_id, {_N('mem_id')} member_id, {_N('loan_id')} loan_id, {_N('grade')} grade,
  {_N('sub_grade')} sub_grade, {_N('emp_title')} employee_designation,
  case when emp_length in ('n/a', 'null') then null when emp_length in ('1 year', '< 1 year') then '1'
    else regexp_extract(emp_length, '^[0-9]+') end employee_experience,
  {_N('home_ownership')} home_ownership, annual_inc annual_income, {_N('verification_status')} verification_status,
  tot_hi_cred_lim total_high_credit_limit, {_N('application_type')} application_type,
  annual_inc_joint annual_income_joint, {_N('verification_status_joint')} verification_status_joint
from ({_RAW['accounts']}) r""",
    "customers": f"""
select sha256(mem_id || cast(age as varchar) || state) customer_key, {_N('cust_id')} customer_id,
  {_N('mem_id')} member_id, {_N('fst_name')} first_name, {_N('lst_name')} last_name,
  {_N('prm_status')} premium_status, age, {_N('state')} state, {_N('country')} country
from ({_RAW['customers']}) r""",
    "defaulters": f"""
select sha256(loan_id || mem_id || def_id) loan_defaulter_key, {_N('loan_id')} loan_id, {_N('mem_id')} member_id,
  {_N('def_id')} loan_default_id, delinq_2yrs defaulters_2yrs, delinq_amnt defaulters_amount,
  pub_rec public_records, pub_rec_bankruptcies public_records_bankruptcies, inq_last_6mths enquiries_6mnths,
  total_rec_late_fee late_fee, {_N('hardship_flag')} hardship_flag, {_N('hardship_type')} hardship_type,
  hardship_length, hardship_amount
from ({_RAW['defaulters']}) r""",
    "investors": f"""
select sha256(investor_loan_id || loan_id || investor_id) investor_key, investor_loan_id, loan_id, investor_id,
  loan_funded_amount, investor_type, age, state, country
from ({_RAW['investors']}) r""",
    "loans": f"""
select sha256(loan_id || mem_id || acc_id) loan_key, {_N('loan_id')} loan_id, {_N('mem_id')} member_id,
  {_N('acc_id')} account_id, loan_amt loan_amount, fnd_amt funded_amount,
  {_N("regexp_replace(term, ' months', '', 'g')")} term, {_N("regexp_replace(interest, '%', '', 'g')")} interest,
  installment, issue_date, {_N('loan_status')} loan_status, {_N('purpose')} purpose, {_N('title')} title,
  {_N('disbursement_method')} disbursement_method
from ({_RAW['loans']}) r""",
    "payments": f"""
select sha256(loan_id || mem_id || latest_transaction_id) payment_key, {_N('loan_id')} loan_id,
  {_N('mem_id')} member_id, {_N('latest_transaction_id')} latest_transaction_id,
  funded_amnt_inv funded_amount_investor, total_pymnt_rec total_payment_recorded, installment,
  last_pymnt_amnt last_payment_amount, last_pymnt_d last_payment_date, next_pymnt_d next_payment_date,
  {_N('pymnt_method')} payment_method
from ({_RAW['payments']}) r""",
}

_KEY_PARTS = {
    "accounts": ("account_key", ("acc_id", "mem_id", "loan_id"), True),
    "customers": ("customer_key", ("mem_id", "age", "state"), False),
    "defaulters": ("loan_defaulter_key", ("loan_id", "mem_id", "def_id"), False),
    "investors": ("investor_key", ("investor_loan_id", "loan_id", "investor_id"), False),
    "loans": ("loan_key", ("loan_id", "mem_id", "acc_id"), False),
    "payments": ("payment_key", ("loan_id", "mem_id", "latest_transaction_id"), False),
}


def _key_nulls() -> str:
    out = []
    for name, (_, parts, resolved) in _KEY_PARTS.items():
        texts = [f"cast({p} as varchar)" for p in parts]
        missing = " or ".join(f"{t} is null or {t} = 'null'" for t in texts)
        raw_key = f"sha256({' || '.join(texts)})"
        stored = f"sha256({' || '.join(map(_N, texts))})" if resolved else raw_key
        rows = f"from ({_RAW[name]}) r where ({missing})"
        out.append(f"select '{name}' source, {stored} stored_key, count(*) key_rows {rows} group by 1, 2")
        out.append(
            f"select '{name} raw' source, {raw_key} stored_key, count(*) key_rows {rows}"
            f" and {raw_key} is not null group by 1, 2"
        )
    return "\nunion all\n".join(out)


# --- scoring ----------------------------------------------------------------------------------


def _incidents(column: str, many: int) -> str:
    return (
        f"case when {column} between 0 and 5 then [800, 250, 250, 100, 100, 100][{column} + 1]"
        f" when {column} < 0 then null else {many} end"
    )


def _with_points(source: dict[str, str]) -> str:
    """CTEs pay, def and fin: the points after each join."""
    return f"""
with payment_rows as ({source["payments"]}),
customer_rows as ({source["customers"]}),
defaulter_rows as ({source["defaulters"]}),
loan_rows as ({source["loans"]}),
account_rows as ({source["accounts"]}),
pay as (
  select c.member_id, c.state, c.country, c.first_name, c.last_name,
    cast(case
      when p.last_payment_amount is null or p.installment is null then 0
      when p.last_payment_amount = p.installment then 500
      when p.last_payment_amount < p.installment then
        if(cast(p.last_payment_amount as double) < cast(p.installment as double) / 2, 100, 250)
      else if(cast(p.last_payment_amount as double) > cast(p.installment as double) * cast(1.5 as double), 800, 650)
    end as integer) last_payment_pts,
    cast(case
      when p.total_payment_recorded is null then 0
      when cast(p.total_payment_recorded as double) >= p.funded_amount_investor / 2 then 650
      when p.total_payment_recorded = 0 then 0
      when p.total_payment_recorded > 0 and p.funded_amount_investor is not null then 500
    end as integer) total_payment_pts
  from payment_rows p, customer_rows c where p.member_id = c.member_id
),
def as (
  select pay.*,
    {_incidents("d.defaulters_2yrs", 0)} delinq_pts,
    {_incidents("d.public_records", 100)} public_records_pts,
    {_incidents("d.public_records_bankruptcies", 0)} public_bankruptcies_pts,
    {_incidents("d.enquiries_6mnths", 0)} enq_pts,
    case coalesce(d.hardship_flag, 'Y') when 'N' then 650 when 'Y' then 250 end hardship_pts
  from defaulter_rows d left join pay on pay.member_id = d.member_id
),
fin as (
  select def.*,
    case
      when contains(lower(l.loan_status), 'fully paid') then 800
      when contains(lower(l.loan_status), 'current') then 500
      when contains(lower(l.loan_status), 'in grace period') then 250
      when regexp_matches(lower(l.loan_status), 'late \\((16-30|31-120) days\\)') then 100
      when contains(lower(l.loan_status), 'charged off') then 0
    end loan_status_pts,
    case
      when a.home_ownership is null then 100
      when contains(lower(a.home_ownership), 'own') then 800
      when contains(lower(a.home_ownership), 'rent') then 500
      when contains(lower(a.home_ownership), 'mortgage') then 250
      when contains(lower(a.home_ownership), 'any') then 100
    end home_pts,
    [800, 650, 500, 250, 100, 0][1 + len(list_filter(
      [cast(0.1 as double), cast(0.2 as double), cast(0.3 as double), cast(0.5 as double), cast(0.7 as double)],
      lambda share: l.funded_amount > cast(a.total_high_credit_limit as double) * share))
      + nullif(0, if(l.funded_amount is null or a.total_high_credit_limit is null, 0, 1))] credit_limit_pts,
    cast(case
      when length(a.grade) = 1 and length(a.sub_grade) = 2
        and contains('ABCDEFG', a.grade) and contains('12345', a.sub_grade[2])
        and least(instr('ABCDEFG', a.grade), 6) = least(instr('ABCDEFG', a.sub_grade[1]), 6)
      then [800, 650, 500, 250, 100, 0, 0][instr('ABCDEFG', a.grade)] * (6 - cast(a.sub_grade[2] as integer)) * 0.20
    end as decimal(12, 2)) grade_pts
  from def
  left join loan_rows l on l.member_id = def.member_id
  left join account_rows a on a.member_id = def.member_id
),
comp as (
  select member_id, first_name, last_name, state, country,
    cast((last_payment_pts + total_payment_pts) * 0.20 as decimal(13, 2)) payment_history_pts,
    cast((delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts + hardship_pts) * 0.45
      as decimal(13, 2)) defaulters_history_pts,
    cast((loan_status_pts + home_pts + credit_limit_pts + grade_pts) * 0.35 as decimal(16, 4)) financial_health_pts
  from fin
),
scored as (
  select member_id, first_name, last_name, state, country,
    cast(payment_history_pts + defaulters_history_pts + financial_health_pts as decimal(17, 4)) loan_score
  from comp
),
graded as (
  select *, ['F', 'E', 'D', 'C', 'B', 'A'][1 + len(list_filter([750, 1000, 1500, 2000, 2500],
    lambda cut: loan_score > cut)) + nullif(0, if(loan_score is null, 0, 1))] loan_final_grade
  from scored
)
"""


_POINTS = _with_points({name: as_oracle(sql) for name, sql in fixtures.CLEANED.items()})
_HOT_POINTS = _with_points({name: as_oracle(sql) for name, sql in fixtures.HOT.items()})
_CSV_POINTS = _with_points({n: CLEAN[n] for n in fixtures.CLEANED})
_GRADED = _POINTS + "select * from graded"

OTHER_PARAMS = {
    "very_bad": 110, "bad": 240, "good": 520, "very_good": 640, "excellent": 810,
    "cut_f": 700, "cut_e": 1010, "cut_d": 1400, "cut_c": 2050, "cut_b": 2450,
    "grade_a": "S", "grade_c": "T", "grade_f": "Z",
}


def _with_other_params() -> str:
    """The graded rows with the numbers and letters of the rules replaced; the tables above them stay."""
    tables, mark, rules = _GRADED.partition("pay as (")
    other = OTHER_PARAMS
    points = {"100": other["very_bad"], "250": other["bad"], "500": other["good"], "650": other["very_good"], "800": other["excellent"]}
    rules = re.sub(r"(?<![\d.-])(100|250|500|650|800)(?![\d.])", lambda m: str(points[m[1]]), rules)
    rules = rules.replace("[750, 1000, 1500, 2000, 2500]", str([other[f"cut_{c}"] for c in "fedcb"]))
    letters = [other.get(f"grade_{c}", c.upper()) for c in "fedcba"]
    return tables + mark + rules.replace("['F', 'E', 'D', 'C', 'B', 'A']", str(letters))

_TABLE_ROWS = " union all ".join(
    f"select '{name}' \"table\", count(*) rows_written, 'Success' status from ({sql}) t"
    for name, sql in _RAW.items()
)

ORACLE_SQL = {
    **{
        f"csv_scan_{'typed' if name == 'payments' else name}": _parsed(fields, types, f"{key} % 11 = 0", source)
        for name, (fields, _, key, source, types) in _FAULTY.items()
    },
    "landing_snapshot": f"""
        select *, '2024-05-01' landed_on from ({_RAW["loans"]}) r where cast(loan_id as bigint) % 2 <> 0
        union all select *, '2024-05-02' from ({_RAW["loans"]}) r""",
    "landing_reparsed": _parsed(
        _LOAN_FIELDS | {"issue_date": _REPARSED_DATE}, _FAULTY["loans"][4], "o_orderkey % 11 = 0", "orders"
    ),
    "parquet_append_twice": f"{CLEAN['defaulters']} union all {CLEAN['defaulters']}",
    **{f"clean_{name}": sql for name, sql in CLEAN.items()},
    "ingest_dates": f"select count(*) dated_rows, cast(1 as bigint) dates from ({_RAW['accounts']}) r",
    "surrogate_key_nulls": _key_nulls(),
    "pts_payment": _POINTS + "select * from pay",
    "pts_defaulters": _POINTS + "select * from def",
    "pts_financial": _POINTS + "select * from fin",
    "score_components": _POINTS + "select * from comp",
    "loan_score": _POINTS + "select * from scored",
    "loan_grade": _GRADED,
    "loan_grade_params": _with_other_params(),
    "loan_grade_hot_member": _HOT_POINTS + "select * from graded",
    "loan_grade_hot_product": _HOT_POINTS + "select * from graded",
    "payment_exceptions": _POINTS
    + "select * from pay where not coalesce(last_payment_pts = 500 and coalesce(total_payment_pts, 500) = 500, false)",
    "grade_b_members": _POINTS + "select * from graded where loan_final_grade = 'B'",
    "publish_scores": _GRADED,
    "distinct_experience": f"""
        select distinct emp_length experience, 'raw' stage from ({_RAW["accounts"]}) r
        union all select distinct employee_experience, 'cleaned' from ({CLEAN["accounts"]}) c""",
    "null_experience": f"select * from ({CLEAN['accounts']}) c where employee_experience is null",
    "loans_36m_over_5pct": f"""
        select * from ({CLEAN["loans"]}) c
        where try_cast(term as bigint) = 36 and try_cast(interest as double) > 5""",
    "ingest_all": _TABLE_ROWS,
    "score_from_csv": _CSV_POINTS + "select * from graded",
    "register_views": f"""
        select l.loan_id, l.member_id, l.funded_amount, i.investor_type, i.loan_funded_amount
        from ({CLEAN["loans"]}) l join ({CLEAN["investors"]}) i on i.loan_id = l.loan_id""",
}
