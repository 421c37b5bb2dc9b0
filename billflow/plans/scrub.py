"""O-48: raw attendance -> exception / manual / straightforward work lists.

One lazy plan: every dimension (rule lists, client export) is joined by a
size-checked broadcast, so the attendance rows are never shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from billflow.functions.nulls import is_yes, match_or_false, ne_keep_null
from billflow.functions.text import recode_contains
from billflow.operators import gates
from billflow.operators.joins import maybe_broadcast
from billflow.operators.lookups import first_by_position, payor_lookup, recode_payor
from billflow.schema import CANCEL_STATUSES, GATED_STATUS_RULE, INACTIVE_MARK, KEPT, SELF_PAY
from billflow.sources.files import write_routes
from billflow.sources.rules import rule_values


def scrub_open(attendance: DataFrame, rules: DataFrame) -> DataFrame:
    """Open (not billed) rows that pass the status and procedure-code rules."""
    df = gates.open_rows(attendance)
    df = gates.status_exclusion(df, rules)
    return gates.code_gate(df, rules)


def scrub_manual(attendance: DataFrame, clients: DataFrame, rules: DataFrame,
                 dup: str = "fanout") -> DataFrame:
    """Open, gated rows with their payor, minus inactive staff and excluded clients."""
    df = payor_lookup(scrub_open(attendance, rules), clients, dup=dup)
    df = recode_payor(df)
    df = gates.drop_inactive_staff(df)
    return gates.client_exclusion(df, rules)


def scrub_straightforward(attendance: DataFrame, clients: DataFrame, rules: DataFrame,
                          asof: dt.date, dup: str = "fanout") -> DataFrame:
    """The day's billable cases: payor known, service on a lookback day, not self-pay."""
    df = gates.drop_blank(scrub_manual(attendance, clients, rules, dup))
    df = gates.business_day_lookback(df, asof)
    return gates.drop_self_pay(df)


def scrub_exception(attendance: DataFrame, rules: DataFrame, symmetric: bool = False) -> DataFrame:
    """Billed rows that break a rule (for review)."""
    return gates.billed_exception_gate(gates.billed_rows(attendance), rules, symmetric=symmetric)


def scrub_routes(attendance: DataFrame, clients: DataFrame, rules: DataFrame,
                 asof: dt.date, dup: str = "fanout") -> DataFrame:
    """All three outputs of one run from ONE scan, tagged by ``route``.

    Each rule becomes a flag instead of a filter (anti joins become left joins
    against the same broadcast lists), the payor lookup only matches open rows
    (billed rows never fan out), and each row is exploded into the routes it
    belongs to (a straightforward row is also a manual row). Same rows as the
    three separate queries, one read of the attendance data.
    """
    cols = attendance.columns
    df = gates._with_code_match(attendance, rules, "status", "service_type")
    for rule, col, flag in (("exclude_status", "status", "_excluded"),
                            ("exception_client", "client_id", "_exc_client")):
        vals = rule_values(rules, rule, "_v").distinct().withColumn(flag, F.lit(True))
        df = df.join(maybe_broadcast(vals), F.col(col) == F.col("_v"), "left").drop("_v")
        df = df.withColumn(flag, match_or_false(F.col(flag)))
    billed = is_yes(F.col("is_billed"))
    st, m = F.col("status"), F.col("_code_match")
    gated = match_or_false(st.isin(list(GATED_STATUS_RULE)))
    open_ok = ~billed & ~F.col("_excluded") & (~gated | m)
    exc_ok = billed & ~F.col("_excluded") & (ne_keep_null(st, CANCEL_STATUSES[0]) | ~m) & \
        (ne_keep_null(st, CANCEL_STATUSES[1]) | ~m) & (ne_keep_null(st, KEPT) | m)
    dim = clients.select(F.col("client_id").alias("_lk_key"), F.col("payor").alias("_payor"),
                         "position")
    if dup == "first":
        dim = first_by_position(dim, ["_lk_key"], ["position"], ["_payor"])
    dim = dim.select("_lk_key", "_payor", F.lit(True).alias("_for_open"))
    df = df.withColumn("_open_ok", open_ok).withColumn("_exc_ok", exc_ok)
    df = df.join(dim, F.col("client_id").eqNullSafe(F.col("_lk_key"))
                 & F.col("_open_ok").eqNullSafe(F.col("_for_open")), "left")
    payor = recode_contains(F.col("_payor"))
    manual_ok = F.col("_open_ok") & ~match_or_false(F.col("staff").contains(INACTIVE_MARK)) & \
        ~F.col("_exc_client")
    days = [d.strftime("%m/%d/%Y") for d in gates.lookback_dates(asof)]
    straight_ok = manual_ok & payor.isNotNull() & F.substring("date_time", 1, 10).isin(days) & \
        ne_keep_null(payor, SELF_PAY)
    routes = F.filter(F.array(F.when(F.col("_exc_ok"), F.lit("exception")),
                              F.when(manual_ok, F.lit("manual")),
                              F.when(straight_ok, F.lit("straightforward"))),
                      lambda r: r.isNotNull())
    out = df.select(*cols, payor.alias("payor_name"), F.explode(routes).alias("route"))
    return out.withColumn("payor_name", F.when(F.col("route") != "exception", F.col("payor_name")))


def run_scrub(attendance: DataFrame, clients: DataFrame, rules: DataFrame, asof: dt.date,
              out_path: str) -> dict[str, int]:
    """Write the day's three outputs in one job; return rows per route.

    The counts come from ``observe()`` on the same job that writes, so the
    outputs are not re-read or recounted.
    """
    obs = Observation("scrub_routes")
    tagged = scrub_routes(attendance, clients, rules, asof)
    measured = tagged.observe(obs, *[F.sum(F.when(F.col("route") == r, 1).otherwise(0)).alias(r)
                                     for r in ("exception", "manual", "straightforward")])
    write_routes(measured, out_path, asof)
    return {k: int(v or 0) for k, v in obs.get.items()}
