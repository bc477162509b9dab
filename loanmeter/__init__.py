"""Loan data cleaning and member scoring on Spark DataFrames."""

from loanmeter.params import ScoreParams
from loanmeter.plans.clean import (
    clean,
    clean_accounts,
    clean_customers,
    clean_defaulters,
    clean_investors,
    clean_loans,
    clean_payments,
)
from loanmeter.plans.ingest import IngestConfig, IngestError, ingest_all, ingest_table
from loanmeter.plans.score import ScoreTables, score_members
from loanmeter.sources.cleaned import append_clean, read_clean, read_score_tables, register_views
from loanmeter.sources.published import publish_scores
from loanmeter.sources.raw import land_snapshot, read_raw, read_snapshot, reparse_snapshot
from loanmeter.tables import TABLES

__all__ = [
    "IngestConfig",
    "IngestError",
    "ScoreParams",
    "ScoreTables",
    "TABLES",
    "append_clean",
    "clean",
    "clean_accounts",
    "clean_customers",
    "clean_defaulters",
    "clean_investors",
    "clean_loans",
    "clean_payments",
    "ingest_all",
    "ingest_table",
    "land_snapshot",
    "publish_scores",
    "read_clean",
    "read_raw",
    "read_score_tables",
    "read_snapshot",
    "register_views",
    "reparse_snapshot",
    "score_members",
]
