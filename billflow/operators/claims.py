"""Charge, routing, exception and claim-building rules (O-40 .. O-43, O-45)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billflow.functions.nulls import match_or_false
from billflow.functions.text import code_head, date_text, extract_codes
from billflow.operators.joins import unique_left_join
from billflow.schema import (CANCEL_FEE, CANCEL_STATUSES, CLAIM_ASSIGNMENT, CLAIM_FREQUENCY,
                             CLAIM_RELEASE, CLAIM_SIGNATURE, DEFAULT_UNITS, EXC_AWAITING,
                             EXC_CLIENT_NOT_FOUND, EXC_NO_DX, EXC_NO_PROVIDER, EXC_NO_SERVICE,
                             NO_DX_LABEL, YES, ZERO_AMOUNT)


def _cancel():
    return match_or_false(F.col("status").isin(list(CANCEL_STATUSES)))


def dx_present(df: DataFrame, text: str = "ln_dx_text") -> DataFrame:
    """``dx_ok``: the diagnosis text does not carry the 'no billable diagnosis' label."""
    return df.withColumn("dx_ok", ~match_or_false(F.col(text).contains(NO_DX_LABEL)))


# ---- O-40 charge rule -------------------------------------------------------------

def charge_rule(df: DataFrame, fee: str = CANCEL_FEE) -> DataFrame:
    """Late Cancel / No Show: charge = client share = fee, insurer 0.00;
    otherwise client share 0.00, units 1, charge as listed."""
    c = _cancel()
    return df.withColumns({
        "charge_amount": F.when(c, F.lit(fee)).otherwise(F.col("ln_amount")),
        "client_amount": F.when(c, F.lit(fee)).otherwise(F.lit(ZERO_AMOUNT)),
        "insurer_amount": F.when(c, F.lit(ZERO_AMOUNT)),
        "quantity": F.when(c, F.col("ln_units")).otherwise(F.lit(DEFAULT_UNITS)),
    })


def money_cents(c) -> F.Column:
    """Money text -> integer cents (NULL when not a number)."""
    return (c.try_cast("decimal(12,2)") * 100).try_cast("bigint")


# ---- O-41a routing ------------------------------------------------------------------

def case_routing(df: DataFrame, private: str = "is_private") -> DataFrame:
    """private payor -> claim file; Late Cancel / No Show -> save only; else await."""
    return df.withColumn("route", F.when(F.col(private), "claim_file")
                         .when(_cancel(), "save_only").otherwise("await_submission"))


# ---- O-45 outcome apply ----------------------------------------------------------

def latest_outcome(outcomes: DataFrame) -> DataFrame:
    """Latest outcome per case (largest ``seq``), combined map-side."""
    last = F.max_by(F.struct("ok", "transaction_no", "error_text"), F.col("seq")).alias("_o")
    return outcomes.groupBy("case_id").agg(last).select(
        "case_id", F.col("_o.ok").alias("out_ok"), F.col("_o.transaction_no").alias("out_txn"),
        F.col("_o.error_text").alias("out_error"))


def with_outcome(df: DataFrame, outcomes: DataFrame, key: str = "item_id", rows: DataFrame | None = None) -> DataFrame:
    lo = latest_outcome(outcomes)
    j = unique_left_join(df, lo, [(F.col(key), "case_id")], key, rows)
    return j.withColumns({"out_found": F.col("out_ok").isNotNull()}).drop("case_id")


def apply_outcome(df: DataFrame) -> DataFrame:
    """Submitted claims: ok -> billed (claim files also get the transaction
    number and Status = Yes); failure -> the fixed exception text, with the
    portal's own text in ``error_detail``."""
    ok = match_or_false(F.col("out_ok"))
    bad = F.col("out_found") & ~ok
    claim_file = F.col("route") == "claim_file"
    return df.withColumns({
        "is_billed": F.when(ok, F.lit(YES)).otherwise(F.col("is_billed")),
        "exceptions": F.when(bad, F.lit(EXC_AWAITING)),
        "error_detail": F.when(bad, F.col("out_error")),
        "transaction_number": F.when(ok & claim_file, F.col("out_txn")),
        "submitted": F.when(ok & claim_file, F.lit(YES)),
    })


# ---- O-41b exception tagging ----------------------------------------------------------

def exception_tagging(df: DataFrame) -> DataFrame:
    """First failing check wins; a case with an exception is not billed.

    Order: client not found; no service on the date; no diagnosis; no provider
    in the chosen master table; a private payor without active coverage; a failed
    submission (its own text goes to ``error_detail``). ``is_billed`` keeps its
    prior value unless the case bills.
    """
    awaiting_fail = (F.col("route") == "await_submission") & \
        F.col("out_found") & ~match_or_false(F.col("out_ok"))
    checked = (F.when(~F.col("reg_found"), F.lit(EXC_CLIENT_NOT_FOUND))
               .when(~F.col("svc_found"), F.lit(EXC_NO_SERVICE))
               .when(~F.col("dx_ok"), F.lit(EXC_NO_DX))
               .when(~F.col("provider_found"), F.lit(EXC_NO_PROVIDER))
               .when((F.col("route") == "claim_file") & ~F.col("cov_found"), F.lit(EXC_AWAITING)))
    failed = checked.isNull() & awaiting_fail
    exc = F.when(failed, F.lit(EXC_AWAITING)).otherwise(checked)
    bills = exc.isNull() & (F.col("route").isin("save_only", "claim_file")
                            | match_or_false(F.col("out_ok")))
    return df.withColumns({
        "exceptions": exc, "error_detail": F.when(failed, F.col("out_error")),
        "is_billed": F.when(bills, F.lit(YES)).otherwise(F.col("is_billed"))})


# ---- O-43 claim record ----------------------------------------------------------------

def claim_record(df: DataFrame) -> DataFrame:
    """The 20-column flat claim record of each clean private-payor case."""
    ok = (F.col("route") == "claim_file") & F.col("exceptions").isNull()
    # The attendance export's client name when it has one, else the registry's.
    name = F.col("reg_full_name")
    if "client_name" in df.columns:
        name = F.coalesce(F.col("client_name"), name)
    return df.filter(ok).select(
        "item_id",
        name.alias("client_name"), "client_id", "date_time",
        "service_type", "staff", "payor_name",
        F.col("reg_first_name").alias("first_name"), F.col("reg_last_name").alias("last_name"),
        F.col("reg_dob").alias("dob"), F.col("reg_gender").alias("gender"),
        F.col("reg_street").alias("street"), F.col("reg_city").alias("city"),
        F.col("reg_state").alias("state"), F.col("reg_zip").alias("zip"),
        "claim_invoice_number", F.col("cov_insured_id").alias("insurance_number"),
        F.col("ln_place_of_service").alias("place_of_service"),
        extract_codes(F.col("ln_dx_text")).alias("dx_code"),
        "charge_amount", "quantity",
    )


# ---- O-42 claim assembly ----------------------------------------------------------------

def claim_assembly(records: DataFrame) -> DataFrame:
    """One nested claim form per record.

    Diagnosis i takes slot i and pointer i+1; from- and to-date are the
    service date; the state comes from the record (not a constant).
    """
    codes = F.split(F.col("dx_code"), ",")
    diagnoses = F.transform(codes, lambda c, i: F.struct(i.alias("slot"), c.alias("code")))
    pointers = F.transform(codes, lambda c, i: i + 1)
    day = date_text(F.col("date_time"))
    claim = F.struct(
        F.struct("first_name", "last_name", "dob", "gender", "street", "city", "state",
                 F.col("zip").alias("zip_code")).alias("patient"),
        F.struct(F.col("insurance_number").alias("member_id"),
                 F.col("payor_name").alias("payer")).alias("subscriber"),
        F.struct(F.col("portal_rendering").alias("rendering"),
                 F.col("portal_billing").alias("billing")).alias("providers"),
        F.struct(
            F.lit(CLAIM_FREQUENCY).alias("frequency"),
            F.lit(CLAIM_ASSIGNMENT).alias("assignment"),
            F.lit(CLAIM_RELEASE).alias("release"),
            F.lit(CLAIM_SIGNATURE).alias("signature"),
            F.col("place_of_service").alias("place_of_service"),
            F.col("claim_invoice_number").alias("patient_control_number"),
            diagnoses.alias("diagnoses"),
            F.array(F.struct(day.alias("from_date"), day.alias("to_date"),
                             code_head(F.col("service_type")).alias("procedure_code"),
                             F.col("charge_amount").alias("amount"),
                             F.col("quantity").alias("quantity"),
                             pointers.alias("pointers"))).alias("service_lines"),
        ).alias("claim_information"),
    )
    return records.select("item_id", claim.alias("claim"))


def flatten_claim(claims: DataFrame) -> DataFrame:
    """Scalar view of every field of a nested claim (for reports and comparisons)."""
    ci = "claim.claim_information"
    sl = F.col(f"{ci}.service_lines").getItem(0)
    text = lambda items, f: F.array_join(F.transform(items, lambda x: f(x).cast("string")), ",")
    diagnoses = F.col(f"{ci}.diagnoses")
    return claims.select(
        "item_id",
        *[F.col(f"claim.patient.{c}").alias(f"patient_{c}")
          for c in ("first_name", "last_name", "dob", "gender", "street", "city", "state")],
        F.col("claim.patient.zip_code").alias("patient_zip"),
        F.col("claim.subscriber.member_id").alias("member_id"),
        F.col("claim.subscriber.payer").alias("payer"),
        F.col("claim.providers.rendering").alias("rendering"),
        F.col("claim.providers.billing").alias("billing"),
        F.col(f"{ci}.frequency").alias("frequency"),
        F.col(f"{ci}.assignment").alias("assignment"),
        F.col(f"{ci}.release").alias("release_info"),
        F.col(f"{ci}.signature").alias("signature"),
        F.col(f"{ci}.place_of_service").alias("place_of_service"),
        F.col(f"{ci}.patient_control_number").alias("control_number"),
        F.size(diagnoses).cast("bigint").alias("n_diagnoses"),
        text(diagnoses, lambda d: d["slot"]).alias("dx_slots"),
        text(diagnoses, lambda d: d["code"]).alias("dx_codes"),
        F.size(F.col(f"{ci}.service_lines")).cast("bigint").alias("n_service_lines"),
        sl.getField("from_date").alias("from_date"),
        sl.getField("to_date").alias("to_date"),
        sl.getField("procedure_code").alias("procedure_code"),
        sl.getField("amount").alias("amount"),
        sl.getField("quantity").alias("quantity"),
        text(sl.getField("pointers"), lambda p: p).alias("pointers"),
    )


# ---- O-42b diagnosis explode ------------------------------------------------------------

def diagnosis_explode(records: DataFrame) -> DataFrame:
    """One row per diagnosis code: slot (0-based) and pointer (slot + 1)."""
    return (records.select("item_id", F.posexplode(F.split(F.col("dx_code"), ",")))
            .select("item_id", F.col("pos").cast("bigint").alias("slot"), F.col("col").alias("code"),
                    (F.col("pos") + 1).cast("bigint").alias("pointer")))
