"""Straightforward cases -> worked cases and claim records (P3 -> A1 -> A2).

The source works one case at a time against a web portal; here every check is
a set-at-a-time join against the table the portal would have shown, and the
portal's answers arrive as the ``outcomes`` table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billflow.operators import claims as CL
from billflow.operators import matching as M
from billflow.operators.joins import of_keys, sized


@dataclass
class CaseInputs:
    cases: DataFrame
    registry: DataFrame
    lines: DataFrame
    coverage: DataFrame
    invoices: DataFrame
    outcomes: DataFrame
    rules: DataFrame
    by_payor: DataFrame
    by_staff: DataFrame
    by_staff_private: DataFrame
    # Service dates that the cases can have; cuts the line history (None: uncut).
    days: M.DosRange | None = None
    # Cut the histories to the cases' clients and ids before they are reduced. Pays
    # when ``cases`` is a stored table (a job), as it is then read once per history.
    prune: bool = False
    # Find clients by the portal's name search before the id test (needs client_name).
    by_name: bool = False


def worked_cases(x: CaseInputs) -> DataFrame:
    """Every case with its match results, charges, route and exception."""
    clients = x.cases.select("client_id") if x.prune else None
    ids = x.cases.select("item_id") if x.prune else None
    if x.by_name:
        df = M.registry_search(x.cases, x.registry, clients).drop("found_by", "n_shown")
    else:
        df = M.registry_match(x.cases, of_keys(x.registry, "client_id", clients), x.cases)
    df = M.archive_flag(df)
    df = M.service_match(df, of_keys(x.lines, "client_id", clients), x.days, x.cases)
    df = CL.dx_present(df)
    df = CL.charge_rule(df)
    df = M.provider_resolution(df, x.rules, x.by_payor, x.by_staff, x.by_staff_private)
    df = CL.case_routing(df)
    df = M.with_coverage(df, of_keys(x.coverage, "client_id", clients), x.rules, x.cases)
    df = M.first_invoice(df, of_keys(x.invoices, "client_id", clients), x.cases)
    df = CL.with_outcome(df, of_keys(x.outcomes, "case_id", ids), rows=x.cases)
    return CL.exception_tagging(df)


def claims_with_transactions(rec: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Claim records plus the transaction number their submission returned."""
    lo = CL.latest_outcome(outcomes)
    return (rec.join(sized(lo), F.col("item_id") == F.col("case_id"), "left")
            .withColumn("transaction_number", F.when(F.col("out_ok"), F.col("out_txn")))
            .drop("case_id", "out_ok", "out_txn", "out_error"))


def claim_forms(rec: DataFrame, by_staff_private: DataFrame) -> DataFrame:
    """Nested claim forms of the claim records (the submission stage's input)."""
    return CL.claim_assembly(M.portal_providers(rec, by_staff_private))
