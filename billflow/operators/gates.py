"""Row filters of the scrub stage (O-24 .. O-29c).

All of them keep NULLs exactly where the source's pandas masks keep them.
Rule lists are joined from the long rule table (broadcast after a size
check), never collected to the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billflow.functions.nulls import is_yes, match_or_false, ne_keep_null
from billflow.functions.text import code_prefix
from billflow.operators.joins import maybe_broadcast, semi_on
from billflow.schema import (CANCEL_STATUSES, GATED_STATUS_RULE, INACTIVE_MARK, KEPT,
                             SELF_PAY)
from billflow.sources.rules import rule_values


# ---- O-24 billed split -------------------------------------------------------

def tag_billed(df: DataFrame, col: str = "is_billed") -> DataFrame:
    """Add ``route`` = 'billed' / 'open' in one pass (NULL counts as open)."""
    return df.withColumn("route", F.when(is_yes(F.col(col)), "billed").otherwise("open"))


def billed_rows(df: DataFrame, col: str = "is_billed") -> DataFrame:
    return df.filter(is_yes(F.col(col)))


def open_rows(df: DataFrame, col: str = "is_billed") -> DataFrame:
    return df.filter(~is_yes(F.col(col)))


# ---- O-25 exclusions -----------------------------------------------------------

def exclude_values(df: DataFrame, col: str, rules: DataFrame, rule: str) -> DataFrame:
    """Drop rows whose ``col`` is in the rule list; NULL ``col`` is kept.

    A ``left_anti`` on ``=`` never matches a NULL key, which is exactly the
    null-keeping NOT IN; NULL rule values are already gone from the table.
    """
    vals = rule_values(rules, rule, "_excl_value")
    return semi_on(df, vals, F.col(col) == F.col("_excl_value"), "left_anti")


def status_exclusion(df: DataFrame, rules: DataFrame, col: str = "status") -> DataFrame:
    return exclude_values(df, col, rules, "exclude_status")


def client_exclusion(df: DataFrame, rules: DataFrame, col: str = "client_id") -> DataFrame:
    return exclude_values(df, col, rules, "exception_client")


# ---- O-26 / O-27 procedure-code gates -----------------------------------------

def _gate_pairs(rules: DataFrame) -> DataFrame:
    """Distinct (gated status, allowed code) pairs from the code rules."""
    status_of = F.create_map(*[x for s, r in GATED_STATUS_RULE.items()
                               for x in (F.lit(r), F.lit(s))])
    return (rules.filter(F.col("rule_name").isin(list(GATED_STATUS_RULE.values())))
            .select(status_of[F.col("rule_name")].alias("_gate_status"),
                    F.col("value").alias("_gate_code"))
            .distinct())


def _with_code_match(df: DataFrame, rules: DataFrame, status: str, service: str) -> DataFrame:
    """Add ``_code_match``: service code is allowed for the row's own status.

    Mirrors an anchored ``^(c1:|c2:…)`` regex: the text before the first ':'
    must equal a listed code, and a NULL service never matches. An empty list
    matches any non-null service (the regex ``^()``). Two flag joins against
    distinct rule rows (both broadcast after the size check), so no row fans
    out and no list is gathered into one value.
    """
    pairs = _gate_pairs(rules)
    listed = pairs.select(F.col("_gate_status").alias("_listed_status")).distinct() \
        .withColumn("_has_list", F.lit(True))
    hits = pairs.withColumn("_hit", F.lit(True))
    svc = F.col(service)
    j = (df.withColumn("_code", code_prefix(svc))
         .join(maybe_broadcast(hits), (F.col(status) == F.col("_gate_status"))
               & (F.col("_code") == F.col("_gate_code")), "left")
         .join(maybe_broadcast(listed), F.col(status) == F.col("_listed_status"), "left"))
    match = svc.isNotNull() & (~match_or_false(F.col("_has_list")) | match_or_false(F.col("_hit")))
    return j.withColumn("_code_match", match).drop(
        "_code", "_gate_status", "_gate_code", "_hit", "_listed_status", "_has_list")


def code_gate(df: DataFrame, rules: DataFrame, status: str = "status",
              service: str = "service_type") -> DataFrame:
    """O-26: keep unless the status is gated and its service code is not allowed."""
    gated = match_or_false(F.col(status).isin(list(GATED_STATUS_RULE)))
    j = _with_code_match(df, rules, status, service)
    return j.filter(~gated | F.col("_code_match")).drop("_code_match")


def billed_exception_gate(df: DataFrame, rules: DataFrame, status: str = "status",
                          service: str = "service_type", symmetric: bool = False) -> DataFrame:
    """O-27: billed rows that look wrong and go to the exception output.

    Excluded statuses are dropped; a billed No Show / Late Cancel is kept when
    its code is *not* allowed, a billed Kept row when its code *is* allowed
    (the source's asymmetry). ``symmetric=True`` negates the Kept clause too.
    """
    j = _with_code_match(status_exclusion(df, rules, status), rules, status, service)
    m = F.col("_code_match")
    st = F.col(status)
    keep = (ne_keep_null(st, CANCEL_STATUSES[0]) | ~m) & (ne_keep_null(st, CANCEL_STATUSES[1]) | ~m)
    keep = keep & (ne_keep_null(st, KEPT) | (~m if symmetric else m))
    return j.filter(keep).drop("_code_match")


# ---- O-28 inactive staff and blank payor -----------------------------------------

def drop_inactive_staff(df: DataFrame, col: str = "staff") -> DataFrame:
    """Drop staff whose name contains the inactive mark; NULL staff is kept."""
    return df.filter(~match_or_false(F.col(col).contains(INACTIVE_MARK)))


def drop_blank(df: DataFrame, col: str = "payor_name") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def drop_self_pay(df: DataFrame, col: str = "payor_name") -> DataFrame:
    return df.filter(ne_keep_null(F.col(col), SELF_PAY))


# ---- O-29 business-day lookback ---------------------------------------------------

def lookback_dates(asof: dt.date) -> list[dt.date]:
    """Service dates billed on ``asof``: Monday -> Thu, Fri, Sat; else asof - 2."""
    if asof.weekday() == 0:
        return [asof - dt.timedelta(days=d) for d in (4, 3, 2)]
    return [asof - dt.timedelta(days=2)]


def business_day_lookback(df: DataFrame, asof: dt.date, col: str = "date_time") -> DataFrame:
    """Keep rows whose date text (first 10 chars, MM/dd/yyyy) is a lookback day.

    The dates fold to literals on the driver and are tested as prefixes, which
    a scan takes as pushed filters (a test on ``substring`` stays above it).
    """
    keep = F.lit(False)
    for d in lookback_dates(asof):
        keep = keep | F.col(col).startswith(d.strftime("%m/%d/%Y"))
    return df.filter(keep)


# ---- O-29b two-column date window -------------------------------------------------

def date_window(df: DataFrame, cols: tuple[str, str], asof: dt.date, days: int = 2,
                fmt: str = "%m/%d/%Y") -> DataFrame:
    """Keep rows where either text date column is one of asof, asof-1, …"""
    wanted = [(asof - dt.timedelta(days=i)).strftime(fmt) for i in range(days)]
    a, b = (F.col(c) for c in cols)
    return df.filter(match_or_false(a.isin(wanted)) | match_or_false(b.isin(wanted)))


# ---- O-29c resume predicates ------------------------------------------------------

def pending_cases(df: DataFrame) -> DataFrame:
    """Cases still to work: not billed and no exception recorded."""
    return df.filter(~is_yes(F.col("is_billed")) & F.col("exceptions").isNull())


def pending_claims(df: DataFrame) -> DataFrame:
    """Claims not yet submitted (Status != 'Yes')."""
    return df.filter(~is_yes(F.col("submitted")))


def pending_annotations(df: DataFrame, done_state: str) -> DataFrame:
    """Claims whose invoice note is not yet written."""
    done = is_yes(F.col("submitted")) & F.col("transaction_status").eqNullSafe(done_state)
    return df.filter(~done)


def pending_worklist(df: DataFrame, login: Column | str | None = None) -> DataFrame:
    """Work-list rows without a status, optionally for one login."""
    pred = F.coalesce(F.col("wl_status"), F.lit("")) == ""
    if login is not None:
        pred = pred & (F.col("login") == (F.lit(login) if isinstance(login, str) else login))
    return df.filter(pred)
