"""The six tables: raw columns, cleaned names, keys and storage names.

Each table is described once; the CSV schema, the Parquet schema, the renames and the output
order all follow from that description.
"""

from __future__ import annotations

from dataclasses import dataclass

# When the text "null" becomes NULL, relative to building the surrogate key.
BEFORE_KEY = "before key"
AFTER_KEY = "after key"
NEVER = "never"


@dataclass(frozen=True)
class Column:
    raw: str
    type: str
    clean: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    raw_file: str
    folder: str
    key: str
    key_parts: tuple[str, ...]
    null_text: str
    columns: tuple[Column, ...]

    @property
    def raw_schema(self) -> str:
        """DDL of the CSV file; CSV columns bind by position."""
        return ", ".join(f"{c.raw} {c.type}" for c in self.columns)

    @property
    def clean_schema(self) -> str:
        """DDL of the cleaned Parquet table, in output order."""
        data = ", ".join(f"{c.clean} {c.type}" for c in self.columns)
        return f"{self.key} string, ingest_date timestamp, {data}"

    @property
    def clean_columns(self) -> list[str]:
        return [self.key, "ingest_date", *(c.clean for c in self.columns)]


def _columns(text: str) -> tuple[Column, ...]:
    """One line per column: raw name, type and, where it changes, the cleaned name."""
    parts = (line.split() for line in text.strip().splitlines())
    return tuple(Column(p[0], p[1], p[2] if len(p) > 2 else p[0]) for p in parts)


# Names, types and order of every column, key parts, file and folder names.

ACCOUNTS = TableSpec(
    name="accounts",
    raw_file="account_details.csv",
    folder="account_details",
    key="account_key",
    key_parts=("acc_id", "mem_id", "loan_id"),
    null_text=BEFORE_KEY,
    columns=_columns("""
        acc_id                     string  account_id
        mem_id                     string  member_id
        loan_id                    string
        grade                      string
        sub_grade                  string
        emp_title                  string  employee_designation
        emp_length                 string  employee_experience
        home_ownership             string
        annual_inc                 float   annual_income
        verification_status        string
        tot_hi_cred_lim            float   total_high_credit_limit
        application_type           string
        annual_inc_joint           float   annual_income_joint
        verification_status_joint  string
    """),
)

CUSTOMERS = TableSpec(
    name="customers",
    raw_file="loan_customer_data.csv",
    folder="customer_details",
    key="customer_key",
    key_parts=("mem_id", "age", "state"),
    null_text=AFTER_KEY,
    columns=_columns("""
        cust_id     string  customer_id
        mem_id      string  member_id
        fst_name    string  first_name
        lst_name    string  last_name
        prm_status  string  premium_status
        age         int
        state       string
        country     string
    """),
)

DEFAULTERS = TableSpec(
    name="defaulters",
    raw_file="loan_defaulters.csv",
    folder="loan_defaulters",
    key="loan_defaulter_key",
    key_parts=("loan_id", "mem_id", "def_id"),
    null_text=AFTER_KEY,
    columns=_columns("""
        loan_id               string
        mem_id                string  member_id
        def_id                string  loan_default_id
        delinq_2yrs           int     defaulters_2yrs
        delinq_amnt           float   defaulters_amount
        pub_rec               int     public_records
        pub_rec_bankruptcies  int     public_records_bankruptcies
        inq_last_6mths        int     enquiries_6mnths
        total_rec_late_fee    float   late_fee
        hardship_flag         string
        hardship_type         string
        hardship_length       int
        hardship_amount       float
    """),
)

INVESTORS = TableSpec(
    name="investors",
    raw_file="loan_investors.csv",
    folder="investor_details",
    key="investor_key",
    key_parts=("investor_loan_id", "loan_id", "investor_id"),
    null_text=NEVER,
    columns=_columns("""
        investor_loan_id    string
        loan_id             string
        investor_id         string
        loan_funded_amount  float
        investor_type       string
        age                 int
        state               string
        country             string
    """),
)

LOANS = TableSpec(
    name="loans",
    raw_file="loan_details.csv",
    folder="loan_details",
    key="loan_key",
    key_parts=("loan_id", "mem_id", "acc_id"),
    null_text=AFTER_KEY,
    columns=_columns("""
        loan_id              string
        mem_id               string  member_id
        acc_id               string  account_id
        loan_amt             double  loan_amount
        fnd_amt              double  funded_amount
        term                 string
        interest             string
        installment          float
        issue_date           date
        loan_status          string
        purpose              string
        title                string
        disbursement_method  string
    """),
)

PAYMENTS = TableSpec(
    name="payments",
    raw_file="loan_payment.csv",
    folder="payment_details",
    key="payment_key",
    key_parts=("loan_id", "mem_id", "latest_transaction_id"),
    null_text=AFTER_KEY,
    columns=_columns("""
        loan_id                string
        mem_id                 string  member_id
        latest_transaction_id  string
        funded_amnt_inv        double  funded_amount_investor
        total_pymnt_rec        float   total_payment_recorded
        installment            float
        last_pymnt_amnt        float   last_payment_amount
        last_pymnt_d           date    last_payment_date
        next_pymnt_d           date    next_payment_date
        pymnt_method           string  payment_method
    """),
)

# In ingest order.
TABLES = {
    spec.name: spec
    for spec in (CUSTOMERS, LOANS, ACCOUNTS, DEFAULTERS, PAYMENTS, INVESTORS)
}

# The tables the score reads.
SCORE_TABLES = ("payments", "customers", "defaulters", "loans", "accounts")
