"""Work-queue tables derived from the shared benchmark tables.

The benchmark tables hold no billing data, so each binding maps them onto a
work-queue table with Spark expressions (NULLs injected on purpose). Every
binding is a lazy projection of a full table, so its size grows with the
scale factor. The DuckDB twins live in ``billflow.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billflow.schema import NO_DX_LABEL, TXN_UPDATED
from billflow.sources.rules import rules_from_lists

ASOF = dt.date(2026, 11, 30)  # a Monday
BASE_DAY = "2026-11-20"

# Literal rule lists used with the bindings (config parameters, not data).
RULES = {
    "exclude_status": ["Canceled", "Rescheduled", "Upcoming"],
    "no_show_cpts": ["993"],
    "late_cancel_cpts": ["993", "90837"],
    "kept_cpts": ["90837", "90791"],
    "private_payor": ["Plan B"],
    "staff_payor": ["Plan Z"],
    "exception_client": ["5", "7"],
}


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table as one reusable DataFrame per session (one file listing)."""
    key = (id(spark), sf_dir, name)
    if key not in _TABLES or _TABLES[key].sparkSession is not spark:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]


def rules(spark: SparkSession) -> DataFrame:
    return rules_from_lists(spark, RULES)


def _s(c):
    return c.cast("string")


def _rows(df: DataFrame, *rows: F.Column) -> DataFrame:
    """One input row -> several output rows in a single pass (no second scan).

    Each ``rows`` item is a struct, or NULL to emit nothing for that slot.
    """
    arr = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return df.select(F.explode(arr).alias("_r")).select("_r.*")


def service_day(orderkey) -> F.Column:
    return F.date_add(F.lit(BASE_DAY).cast("date"), (orderkey % 14).cast("int"))


def attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``W``: one attendance row per order."""
    o = table(spark, sf_dir, "orders")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("item_id"),
        F.when(ck % 17 != 0, _s(ck)).alias("client_id"),
        F.when(F.col("o_orderstatus") == "F", "Yes")
         .when(F.col("o_orderstatus") == "O", "No").alias("is_billed"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Kept")
         .when(F.col("o_orderpriority") == "2-HIGH", "Late Cancel")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "No Show")
         .when(F.col("o_orderpriority") == "5-LOW", "Canceled").alias("status"),
        F.when(k % 11 != 0, F.concat(
            F.when(k % 4 == 0, "993").when(k % 4 == 1, "90837")
             .when(k % 4 == 2, "90791").otherwise("999"), F.lit(": svc"))).alias("service_type"),
        F.concat(F.date_format(service_day(k), "MM/dd/yyyy"), F.lit(", 10:00 AM ET")).alias("date_time"),
        F.when(ck % 10 == 0, "Staff 0 (Inactive)")
         .when(ck % 13 != 0, F.concat(F.lit("Staff "), _s(ck % 7))).alias("staff"),
    )


def client_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``C``: client -> primary payor, plus a duplicate row for every third client."""
    c = table(spark, sf_dir, "customer")
    ck, seg = F.col("c_custkey"), F.col("c_mktsegment")
    payor = (F.when(seg == "BUILDING", "United Healthcare NY")
             .when(seg == "MACHINERY", "UnitedHealthcare")
             .when(seg == "FURNITURE", "Self Pay")
             .when(seg == "HOUSEHOLD", "Plan B"))
    base = F.struct(F.when(ck != 0, _s(ck)).alias("client_id"), payor.alias("payor"),
                    F.lit(0).alias("position"))
    dup = F.when((ck % 3 == 0) & (ck != 0), F.struct(
        _s(ck).alias("client_id"), F.lit("Plan Z").alias("payor"), F.lit(1).alias("position")))
    return _rows(c, base, dup)


# ---- registry, service lines, coverage, invoices (from customer / orders) ----

def _cents_text(cents) -> F.Column:
    """Integer cents -> 'd.cc' text (exact; no float rounding)."""
    return F.concat(_s(F.floor(cents / 100).cast("bigint")), F.lit("."),
                    F.lpad(_s(cents % 100), 2, "0"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``G``: client registry rows; a client may sit in both tabs or in none."""
    c = table(spark, sf_dir, "customer")
    ck, nk = F.col("c_custkey"), F.col("c_nationkey")
    cols = [
        # every ninth client is listed under an id that no case has
        F.when(ck % 9 == 0, F.concat(F.lit("X"), _s(ck))).otherwise(_s(ck)).alias("client_id"),
        F.concat(F.lit(" Pat"), _s(ck % 100)).alias("first_name"),
        F.when(ck % 2 == 0, F.lit("Q.")).alias("middle_name"),
        F.concat(F.lit("Doe  "), _s(nk)).alias("last_name"),
        F.date_format(F.date_add(F.lit("1980-01-01").cast("date"), (ck % 9000).cast("int")),
                      "MM/dd/yyyy").alias("dob"),
        F.when(ck % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.concat(_s(ck), F.lit(" Main St")).alias("street"),
        F.concat(F.lit("City "), _s(nk)).alias("city"),
        F.when(nk % 3 == 0, "New York").when(nk % 3 == 1, "New Jersey")
         .otherwise("Connecticut").alias("state"),
        F.lpad(_s(ck % 100000), 5, "0").alias("zip"),
    ]
    tab = F.when(ck % 4 == 0, "Archived").otherwise("Active")
    base = F.struct(*cols, tab.alias("tab"))
    both = F.when(ck % 12 == 0, F.struct(*cols, F.lit("Active").alias("tab")))
    return _rows(c, base, both)


def named_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``G`` with last names that depend on the id alone, so that cases can name them."""
    k = F.regexp_replace("client_id", "X", "").cast("bigint")
    return registry(spark, sf_dir).withColumn("last_name", F.concat(F.lit("Doe  "), _s(k % 25)))


def named_cases(cases: DataFrame) -> DataFrame:
    """Cases with the client's name as the attendance export has it: of ids divisible by
    five another person's, of those by seven a former last name, else the registry's."""
    k = F.col("client_id").cast("bigint")
    name = (F.when(k % 5 == 0, F.lit("Alex Other"))
            .when(k % 7 == 0, F.concat(F.lit(" PAT"), _s(k % 100), F.lit("  Before")))
            .otherwise(F.concat(F.lit("Pat"), _s(k % 100), F.when(k % 2 == 0, F.lit(" Q.")).otherwise(F.lit("")),
                                F.lit(" Doe "), _s(k % 25))))
    return cases.withColumn("client_name", name)


def service_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``L``: the service line each order would show in the client ledger."""
    o = table(spark, sf_dir, "orders")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    w_service = F.when(k % 11 != 0, F.concat(
        F.when(k % 4 == 0, "993").when(k % 4 == 1, "90837")
         .when(k % 4 == 2, "90791").otherwise("999"), F.lit(": svc")))
    dx = F.when(k % 13 == 0, F.lit(NO_DX_LABEL)).otherwise(F.concat(
        F.lit("Anxiety (F41."), _s(k % 10), F.lit(") and Depression (F32."), _s(k % 3),
        F.lit(")"), F.when(k % 4 == 0, F.lit(" with (Z63.0)")).otherwise(F.lit(""))))
    return o.select(
        k.alias("line_id"),
        # every fifth line stands under an id that no case has
        F.when(k % 5 == 0, F.concat(F.lit("X"), _s(ck)))
         .when(ck % 17 != 0, _s(ck)).alias("client_id"),
        F.concat(F.date_format(service_day(k), "MM/dd/yyyy"), F.lit(", 10:00 AM")).alias("dos_text"),
        F.when(k % 7 == 0, F.lit("90834: other")).otherwise(w_service).alias("service_type"),
        F.when(k % 2 == 0, "11").otherwise("02").alias("place_of_service"),
        _cents_text((k * 37) % 20000 + 5000).alias("amount"),
        F.when(k % 3 == 0, "2").otherwise("1").alias("units"),
        dx.alias("dx_text"),
        k.alias("position"),
    )


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``V``: two insurance rows per client in list order."""
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    first = F.struct(
        _s(ck).alias("client_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Plan B").otherwise("Plan C").alias("payor"),
        F.when(ck % 3 == 0, "Inactive").otherwise("Active").alias("status"),
        F.concat(F.lit("INS"), _s(ck), F.lit("A")).alias("insured_id"),
        F.lit(0).alias("position"))
    second = F.struct(
        _s(ck).alias("client_id"), F.lit("Plan B").alias("payor"),
        F.when(ck % 2 == 0, "Active").otherwise("Inactive").alias("status"),
        F.concat(F.lit("INS"), _s(ck), F.lit("B")).alias("insured_id"),
        F.lit(1).alias("position"))
    return _rows(c, first, second)


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``I``: open invoices per client and case; every tenth invoice is listed twice."""
    o = table(spark, sf_dir, "orders")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    cols = [F.when(ck % 17 != 0, _s(ck)).alias("client_id"),
            F.concat(F.lit("INV"), _s(k)).alias("invoice_no"), k.alias("case_id")]
    one = F.struct(*cols, F.lit(None).cast("string").alias("note"), (k * 2).alias("position"))
    two = F.when(k % 10 == 0, F.struct(*cols, F.lit("copy").alias("note"),
                                        (k * 2 + 1).alias("position")))
    return _rows(o, one, two)


def prior_state(cases: DataFrame) -> DataFrame:
    """Prior Active/Archived value carried on a case row (from an earlier run)."""
    k = F.col("item_id")
    return cases.withColumn("active_archived", F.when(k % 5 == 0, "Archived")
                            .when(k % 5 == 1, "Active"))


# ---- provider masters (from nation; config-sized) ----

def provider_by_payor(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    nk = F.col("n_nationkey")
    payer = F.when(nk == 0, "Optum").when(nk == 1, "Plan C").when(nk == 2, "Optum") \
        .otherwise(F.concat(F.lit("Payer "), F.col("n_name")))
    return n.select(
        payer.alias("payer"),
        F.concat(F.lit("Rendering "), F.col("n_name")).alias("rendering_provider"),
        F.when(nk % 3 == 0, "No").otherwise(F.concat(F.lit("Billing "), F.col("n_name")))
         .alias("billing_provider"),
        nk.alias("position"))


def provider_by_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    nk = F.col("n_nationkey")
    return n.select(
        F.when(nk == 3, "Absent 3").otherwise(F.concat(F.lit("Staff "), _s(nk))).alias("staff"),
        F.concat(F.lit("Rendering S"), _s(nk)).alias("rendering_provider"),
        F.when(nk % 3 == 0, "No").otherwise(F.concat(F.lit("Billing S"), _s(nk)))
         .alias("billing_provider"),
        nk.alias("position"))


def provider_by_staff_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    nk = F.col("n_nationkey")
    return n.select(
        F.when(nk == 5, "Absent 5").when(nk < 9, F.concat(F.lit("Staff "), _s(nk % 8)))
         .otherwise(F.concat(F.lit("Staff "), _s(nk))).alias("staff"),
        F.concat(F.lit("Rendering P"), _s(nk)).alias("rendering_provider"),
        F.concat(F.lit("Billing P"), _s(nk)).alias("billing_provider"),
        F.concat(F.col("n_name"), F.lit(" MD, NPI "), _s(nk * 111)).alias("portal_rendering_provider"),
        F.concat(F.lit("Group "), _s(F.col("n_regionkey")), F.lit(", NPI 9")).alias("portal_billing_provider"),
        nk.alias("position"))


# ---- outcomes and state log (from events) ----

def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``O``: submission outcomes; two events per case, the later one counts."""
    e = table(spark, sf_dir, "events")
    err = F.col("event_type") == "error"
    return e.select(
        F.expr("event_id div 2").alias("case_id"),
        F.col("event_id").alias("seq"),
        (~err).alias("ok"),
        F.when(~err, F.concat(F.lit("TXN"), _s(F.col("event_id")))).alias("transaction_no"),
        F.when(err, F.concat(F.lit("Submission error "), F.col("props"))).alias("error_text"))


STATE_FIELDS = ("is_billed", "exceptions", "active_archived", "transaction_number",
                "transaction_status")


def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only case-state events ``(case_id, seq, field, value)``."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    field = (F.when(t == "purchase", "is_billed").when(t == "error", "exceptions")
             .when(t == "signup", "active_archived").when(t == "click", "transaction_number")
             .when(t == "view", "transaction_status"))
    value = (F.when(t == "purchase", F.lit("Yes"))
             .when(t == "error", F.concat(F.lit("err "), F.col("props")))
             .when(t == "signup", F.when(F.col("value") > 50, "Archived").otherwise("Active"))
             .when(t == "click", F.concat(F.lit("TXN"), _s(F.col("event_id"))))
             .when(t == "view", F.lit(TXN_UPDATED)))
    return e.select(F.expr("event_id div 3").alias("case_id"), F.col("event_id").alias("seq"),
                    field.alias("field"), value.alias("value"))


# ---- remittance rows, work-list, file inventories ----

def remit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``T``: one remittance row text per order (newline-separated fields)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    k = F.col("o_orderkey")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
    fields = [
        F.concat(F.lit("CHK"), _s(k % 4000)),
        F.concat(F.lit("Payer: "), F.col("c_mktsegment"),
                 F.when(k % 3 == 0, F.lit(" / A|B*")).otherwise(F.lit(""))),
        F.concat(F.lit("Payee <"), F.col("c_name"), F.lit(">")),
        F.date_format(F.date_sub(F.lit(ASOF.isoformat()).cast("date"), (k % 5).cast("int")), "MM/dd/yyyy"),
        F.date_format(F.date_sub(F.lit(ASOF.isoformat()).cast("date"), (k % 7).cast("int")), "MM/dd/yyyy"),
        _cents_text((k * 53) % 100000 + 100),
    ]
    text = F.when(k % 23 == 0, F.concat_ws("\n", *fields[:4])).otherwise(F.concat_ws("\n", *fields))
    return j.select(k.alias("item_id"),
                    # practice 7's rows stand under another name: it is known, but has none
                    F.concat(F.lit("NATION_"), _s(F.col("c_nationkey")),
                             F.when(F.col("c_nationkey") == 7, " branch").otherwise("")).alias("practice"),
                    text.alias("row_text"))


def worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remittance work-list: one row per practice (from nation), every fourth listed
    a second time under another state and RSM."""
    n = table(spark, sf_dir, "nation")
    nk = F.col("n_nationkey")
    state = F.concat(F.lit("State "), _s(F.col("n_regionkey")))
    practice = F.when(nk % 7 == 6, F.lit("Unknown practice")).otherwise(F.col("n_name")).alias("practice")
    login = F.concat(F.lit("login"), _s(F.col("n_regionkey") % 2)).alias("login")
    blank = F.lit(None).cast("string").alias("wl_status")
    one = F.struct(
        login, F.when(nk % 6 == 5, F.lit("Nowhere")).when(nk % 11 == 10, F.lower(state))
        .when(nk % 4 == 0, F.lit("Elsewhere")).otherwise(state).alias("state_name"),
        F.concat(F.lit("RSM "), _s(nk % 3)).alias("rsm"), practice, blank, (nk * 2).alias("position"))
    two = F.when(nk % 4 == 0, F.struct(
        login, state.alias("state_name"), F.concat(F.lit("RSM second "), _s(nk % 3)).alias("rsm"), practice, blank,
        (nk * 2 + 1).alias("position")))
    return _rows(n, one, two)


def known_practices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Practices that the portal offers."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("practice"))


def known_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.concat(F.lit("State "), _s(F.col("r_regionkey"))).alias("state_name"))


def _suffix() -> F.Column:
    e = F.col("event_id")
    return F.when(e % 3 == 0, ".pdf").when(e % 3 == 1, ".csv").otherwise(".xlsx")


def _inventory(e: DataFrame) -> DataFrame:
    return e.select(
        F.concat(F.lit("/landing/"), F.col("event_type"), F.lit("/"), _s(F.col("event_id")), _suffix())
         .alias("path"),
        F.col("ts").cast("timestamp").alias("modificationTime"),
        F.floor(F.col("value") * 100).cast("bigint").alias("length"))


def inventory_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``F``: a landing-folder listing (path, modificationTime, length)."""
    return _inventory(table(spark, sf_dir, "events"))


def inventory_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder as listed at the previous poll (three files in four)."""
    return _inventory(table(spark, sf_dir, "events").filter(F.col("event_id") % 4 != 0))
