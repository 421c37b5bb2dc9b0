"""Case matching against client-side tables (O-30b, O-32a/b, O-34, O-35).

Each candidate table is first reduced to at most one row per join key with a
partial-aggregated ``first_by_position``; the case side then joins at most one
partner per key, so no join ever emits all pairs of a hot key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billflow.functions.nulls import match_or_false, ne_keep_null
from billflow.functions.text import list_head, normalise_name, note_text, strip_zone, to_service_date
from billflow.operators.joins import maybe_broadcast, of_keys, unique_left_join
from billflow.operators.lookups import first_by_position
from billflow.schema import CANCEL_STATUSES, TABS, TXN_UPDATED, INVOICE_NOTE_PREFIX
from billflow.sources.rules import rule_values

REGISTRY_FIELDS = ["tab", "first_name", "middle_name", "last_name", "dob", "gender",
                   "street", "city", "state", "zip"]


def _prefixed(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in keep])


# ---- O-32a registry match -------------------------------------------------------

def best_registry_entry(registry: DataFrame) -> DataFrame:
    """One registry row per client id, Active tab before Archived."""
    rank = F.when(F.col("tab") == TABS[0], 0).when(F.col("tab") == TABS[1], 1).otherwise(2)
    ranked = registry.withColumn("_tab_rank", rank)
    return first_by_position(ranked, ["client_id"], ["_tab_rank"], REGISTRY_FIELDS)


def registry_match(cases: DataFrame, registry: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Add ``reg_found`` and the best registry entry's fields (``reg_*``).

    The name search only narrows the portal's list; the accepting test is
    client-id equality, so this is an equi join on the id. NULL ids never match.
    ``rows``, here and below: see :func:`billflow.operators.joins.unique_left_join`.
    """
    best = _prefixed(best_registry_entry(registry), "reg_", ["client_id"] + REGISTRY_FIELDS)
    j = unique_left_join(cases, best, [(F.col("client_id"), "reg_client_id")], "item_id", rows)
    return j.withColumns({
        "reg_found": F.col("reg_client_id").isNotNull(),
        "reg_full_name": normalise_name(F.col("reg_first_name"), F.col("reg_middle_name"),
                                        F.col("reg_last_name")),
    }).drop("reg_client_id")


BY_FULL, BY_FIRST = "full name", "first token"


def registry_index(registry: DataFrame) -> DataFrame:
    """Inverted index of the registry: (rank, by, term, client_id, the entry's fields).

    In each tab an entry stands under its full name and under each token of it, in
    lower case and with single spaces. ``rank`` is the order of the searches: the
    Active tab before the Archived one, in a tab the full name before the first token.
    """
    name = F.lower(normalise_name(F.col("first_name"), F.col("middle_name"), F.col("last_name")))
    tab = F.when(F.col("tab") == TABS[0], 0).when(F.col("tab") == TABS[1], 2)
    entry = registry.select("client_id", *REGISTRY_FIELDS, tab.alias("_tab"), name.alias("_name")).filter("_tab is not null and _name <> ''")
    under = F.concat(
        F.array(F.struct(F.lit(0).alias("n"), F.lit(BY_FULL).alias("by"), F.col("_name").alias("term"))),
        F.transform(F.array_distinct(F.split("_name", " ")),
                    lambda t: F.struct(F.lit(1).alias("n"), F.lit(BY_FIRST).alias("by"), t.alias("term"))))
    return (entry.select("client_id", *REGISTRY_FIELDS, "_tab", F.explode(under).alias("_u"))
            .select((F.col("_tab") + F.col("_u.n")).alias("rank"), "_u.by", "_u.term", "client_id", *REGISTRY_FIELDS))


def registry_search(cases: DataFrame, registry: DataFrame, clients: DataFrame | None = None) -> DataFrame:
    """O-32a with its candidate stage: the client is looked for by name, and accepted by id.

    In each tab the case's full name is searched, then its first token; the first search
    that shows an entry with the case's client id ends it. So an id that the registry
    lists under another name is not found. Adds ``reg_found``, the entry's fields
    (``reg_*``), ``found_by`` (which search) and ``n_shown`` (entries that it showed; 0 if not found).

    Candidates and the id test are one equi join on (term, client id): entries that
    share a name with very many others are never paired with cases that have another
    id. What each search shows is counted map-side. ``clients`` (a column of ids)
    cuts the entries that are joined, not those that are counted.
    """
    index = registry_index(registry)
    shown = index.groupBy("rank", "term").agg(F.count(F.lit(1)).alias("n_shown"))
    own = of_keys(index, "client_id", clients)
    # of an id's entries under one term the first search, then the entry's own values
    first = first_by_position(own, ["by", "term", "client_id"], ["rank"], ["rank", *REGISTRY_FIELDS])
    values = F.struct(F.col("rank"), F.col("by"), F.col("term"), *[F.col(c).alias("reg_" + c) for c in REGISTRY_FIELDS])
    side = lambda by, n: first.filter(F.col("by") == by).select(
        F.col("term").alias(f"_term{n}"), F.col("client_id").alias(f"_id{n}"), values.alias(f"_hit{n}"))
    name = F.lower(normalise_name(F.col("client_name")))
    j = cases
    for n, (by, term) in enumerate(((BY_FULL, name), (BY_FIRST, F.split(name, " ").getItem(0)))):
        j = unique_left_join(j, side(by, n), [(F.col("client_id"), f"_id{n}"), (term, f"_term{n}")], "item_id", cases)
    # ranks differ between the searches; the one with the lower rank came first
    j = j.withColumn("_hit", F.when(F.col("_hit0").isNull() | (F.col("_hit1.rank") < F.col("_hit0.rank")), F.col("_hit1"))
                     .otherwise(F.col("_hit0")))
    # each case under every search that may have found it: no search is hotter than this says
    may = [F.struct(F.lit(rank).alias("rank"), (name if rank % 2 == 0 else F.split(name, " ").getItem(0)).alias("term")) for rank in range(4)]
    searches = cases.select(F.explode(F.array(*may)).alias("_hit"))
    j = unique_left_join(j, shown.select(F.col("rank").alias("_rank"), F.col("term").alias("_term"), "n_shown"),
                         [(F.col("_hit.rank"), "_rank"), (F.col("_hit.term"), "_term")], "item_id", searches)
    return j.select(*cases.columns, F.col("_hit").isNotNull().alias("reg_found"),
                    *[F.col(f"_hit.reg_{c}").alias(f"reg_{c}") for c in REGISTRY_FIELDS],
                    normalise_name(*[F.col(f"_hit.reg_{c}") for c in ("first_name", "middle_name", "last_name")]).alias("reg_full_name"),
                    F.col("_hit.by").alias("found_by"), F.coalesce("n_shown", F.lit(0)).cast("long").alias("n_shown"))


# ---- O-46 active / archived flag ------------------------------------------------

def archive_flag(matched: DataFrame, prior: str = "active_archived") -> DataFrame:
    """Set the Active/Archived state of found cases and whether to re-archive.

    Found in the Active tab, or prior state not 'Archived' -> 'Active' (so a
    first-time archived client reads 'Active', as in the source); otherwise a
    client found only in Archived -> 'Archived'.
    """
    active = F.col("reg_tab") == TABS[0]
    archived = F.col("reg_tab") == TABS[1]
    p = F.col(prior)
    flag = (F.when(~F.col("reg_found"), p)
            .when(active | ne_keep_null(p, TABS[1]), F.lit(TABS[0]))
            .when(archived, F.lit(TABS[1])).otherwise(p))
    rearchive = F.col("reg_found") & (match_or_false(archived) | p.eqNullSafe(TABS[1]))
    return matched.withColumns({"new_active_archived": flag, "needs_rearchive": rearchive})


# ---- O-32b service-line match ----------------------------------------------------

LINE_FIELDS = ["line_id", "service_type", "place_of_service", "amount", "units", "dx_text"]


DosRange = tuple[dt.date | None, dt.date | None, bool]


def with_dos_date(lines: DataFrame) -> DataFrame:
    """The typed service date (``dos_date``) of a line history, made at ingest so that
    the stored table can be partitioned or pruned by it."""
    return lines if "dos_date" in lines.columns else \
        lines.withColumn("dos_date", to_service_date(F.col("dos_text")))


def dos_range(cases: DataFrame) -> DosRange:
    """First and last service date of the cases, and whether any has a text that is no date."""
    d = to_service_date(F.col("date_time"))
    r = cases.agg(F.min(d).alias("lo"), F.max(d).alias("hi"),
                  F.count_if(d.isNull() & F.col("date_time").isNotNull()).alias("odd")).first()
    return r.lo, r.hi, r.odd > 0


def in_dos_range(lines: DataFrame, days: DosRange) -> DataFrame:
    """The lines that cases of these service dates can match: a literal range on
    ``dos_date``, which reaches the scan. Lines without a date stay if a case has none."""
    lo, hi, odd = days
    c = F.col("dos_date")
    keep = F.lit(False) if lo is None else c.between(F.lit(lo), F.lit(hi))
    return with_dos_date(lines).filter(keep | c.isNull() if odd else keep)


def service_match(cases: DataFrame, lines: DataFrame, days: DosRange | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Add ``svc_found`` and the first matching service line (``ln_*``).

    A line matches when client id and the full date-time text (zone removed)
    are equal; for Late Cancel / No Show the service type must match too.
    Lines are reduced to the first per (client, dos) and per (client, dos,
    service) before the join, so each case meets at most one line per side.

    ``days`` (:func:`dos_range` of the cases, or the days they were selected by)
    cuts the line history first; equal date texts have equal dates, so no match is lost.
    """
    keys = ["client_id", "dos_text"]
    if days:
        lines = in_dos_range(lines, days)
    # One full pass over the lines: first line per (client, dos, service); the
    # first per (client, dos) is then taken from that already-reduced table.
    per_svc = first_by_position(lines.withColumn("_svc", F.col("service_type")),
                                keys + ["_svc"], ["position"], LINE_FIELDS + ["position"])
    svc_line = _prefixed(per_svc, "ls_", keys + ["_svc"] + LINE_FIELDS)
    any_line = _prefixed(first_by_position(per_svc, keys, ["position"], LINE_FIELDS),
                         "la_", keys + LINE_FIELDS)
    dos = strip_zone(F.col("date_time"))
    cancel = match_or_false(F.col("status").isin(list(CANCEL_STATUSES)))
    client = F.col("client_id")
    rows = cases if rows is None else rows
    j = unique_left_join(cases, any_line, [(F.when(~cancel, client), "la_client_id"), (dos, "la_dos_text")], "item_id", rows)
    j = unique_left_join(j, svc_line, [(F.when(cancel, client), "ls_client_id"), (dos, "ls_dos_text"),
                                       (F.col("service_type"), "ls__svc")], "item_id", rows)
    out = j.select(
        *cases.columns,
        *[F.coalesce(F.col("la_" + f), F.col("ls_" + f)).alias("ln_" + f) for f in LINE_FIELDS])
    return out.withColumn("svc_found", F.col("ln_line_id").isNotNull())


def service_match_semi(cases: DataFrame, lines: DataFrame, days: DosRange | None = None) -> DataFrame:
    """Cases that have a service line on their date (left semi)."""
    return service_match(cases, lines, days).filter("svc_found").select(*cases.columns)


def service_match_anti(cases: DataFrame, lines: DataFrame, days: DosRange | None = None) -> DataFrame:
    """Cases without one (the 'no claims on this date' exception)."""
    return service_match(cases, lines, days).filter(~F.col("svc_found")).select(*cases.columns)


# ---- O-34 active coverage -------------------------------------------------------

def active_coverage(coverage: DataFrame, rules: DataFrame) -> DataFrame:
    """First coverage row (list order) per client with a private payor that is Active."""
    private = rule_values(rules, "private_payor", "_pp")
    eligible = coverage.filter(F.col("status") == "Active").join(
        maybe_broadcast(private), F.col("payor") == F.col("_pp"), "left_semi")
    return first_by_position(eligible, ["client_id"], ["position"], ["payor", "insured_id"])


def with_coverage(cases: DataFrame, coverage: DataFrame, rules: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    cov = _prefixed(active_coverage(coverage, rules), "cov_", ["client_id", "payor", "insured_id"])
    j = unique_left_join(cases, cov, [(F.col("client_id"), "cov_client_id")], "item_id", rows)
    return j.withColumns({"cov_found": F.col("cov_client_id").isNotNull()}).drop("cov_client_id")


# ---- O-30b provider resolution ----------------------------------------------------

def payor_flags(df: DataFrame, rules: DataFrame, col: str = "payor_name") -> DataFrame:
    """Add ``is_private`` / ``is_staff_payor``: is the payor on either rule list.

    One small aggregate turns both lists into one row per payor, joined once.
    """
    flags = (rules.filter(F.col("rule_name").isin("private_payor", "staff_payor"))
             .groupBy(F.col("value").alias("_rv"))
             .agg(F.max(F.col("rule_name") == "private_payor").alias("_fp"),
                  F.max(F.col("rule_name") == "staff_payor").alias("_fs")))
    j = df.join(maybe_broadcast(flags), F.col(col) == F.col("_rv"), "left")
    return (j.withColumns({"is_private": match_or_false(F.col("_fp")),
                           "is_staff_payor": match_or_false(F.col("_fs"))})
            .drop("_rv", "_fp", "_fs"))


def provider_masters(by_payor: DataFrame, by_staff: DataFrame,
                     by_staff_private: DataFrame) -> DataFrame:
    """The three provider tables as one, tagged by source; first row per key wins."""
    vals = ["rendering_provider", "billing_provider"]
    parts = [by_payor.select(F.lit("payor").alias("_src"), F.col("payer").alias("_key"), "position", *vals),
             by_staff.select(F.lit("staff").alias("_src"), F.col("staff").alias("_key"), "position", *vals),
             by_staff_private.select(F.lit("staff_private").alias("_src"), F.col("staff").alias("_key"),
                                     "position", *vals)]
    allm = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return first_by_position(allm, ["_src", "_key"], ["position"], vals)


def provider_resolution(cases: DataFrame, rules: DataFrame, by_payor: DataFrame,
                        by_staff: DataFrame, by_staff_private: DataFrame) -> DataFrame:
    """Pick the provider table by precedence, then look the case up in it.

    private payor -> staff table for private payors; payor listed as
    staff-driven -> staff table; otherwise the payor table. A miss in the
    chosen table is a miss (``provider_found`` false): there is no
    fall-through to the next table. One join on (source, key).
    """
    df = payor_flags(cases, rules)
    src = (F.when(F.col("is_private"), "staff_private")
           .when(F.col("is_staff_payor"), "staff").otherwise("payor"))
    df = df.withColumn("provider_source", src)
    key = F.when(F.col("provider_source") == "payor", F.col("payor_name")).otherwise(F.col("staff"))
    m = maybe_broadcast(provider_masters(by_payor, by_staff, by_staff_private))
    j = df.join(m, (F.col("provider_source") == F.col("_src")) & (key == F.col("_key")), "left")
    return j.withColumn("provider_found", F.col("_key").isNotNull()) \
        .drop("_src", "_key", "is_staff_payor")


def portal_providers(claims: DataFrame, by_staff_private: DataFrame) -> DataFrame:
    """Portal-side provider names for claim forms (text before the first comma)."""
    first = first_by_position(by_staff_private, ["staff"], ["position"],
                              ["portal_rendering_provider", "portal_billing_provider"])
    dimp = first.select(F.col("staff").alias("_pv_staff"),
                        list_head(F.col("portal_rendering_provider")).alias("portal_rendering"),
                        list_head(F.col("portal_billing_provider")).alias("portal_billing"))
    return claims.join(maybe_broadcast(dimp), F.col("staff") == F.col("_pv_staff"), "left") \
        .drop("_pv_staff")


# ---- O-35 invoice annotate --------------------------------------------------------

def first_invoice(cases: DataFrame, invoices: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The first open invoice number (list order) of the client for this case.

    The invoice that a case's billing saved is the one listed for its client
    and its case id (or, where the listing has no case id, its service date-time).
    """
    by = "case_id" if "case_id" in invoices.columns else "dos_text"
    inv = first_by_position(invoices, ["client_id", by], ["position"], ["invoice_no"])
    inv = inv.select(F.col("client_id").alias("_inv_client"), F.col(by).alias("_inv_case"),
                     F.col("invoice_no").alias("claim_invoice_number"))
    case = F.col("item_id") if by == "case_id" else strip_zone(F.col("date_time"))
    return unique_left_join(cases, inv, [(F.col("client_id"), "_inv_client"), (case, "_inv_case")],
                            "item_id", rows).drop("_inv_client", "_inv_case")


def invoice_annotate(claims: DataFrame, invoices: DataFrame) -> DataFrame:
    """Write the transaction note onto the first matching open invoice.

    Match is (client id, invoice number); the first listed copy wins. The note
    is only written when a transaction number exists.
    """
    cand = invoices.groupBy("client_id", "invoice_no").agg(F.min("position").alias("_inv_pos")) \
        .select(F.col("client_id").alias("_i_client"), F.col("invoice_no").alias("_i_no"), "_inv_pos")
    j = unique_left_join(claims, cand, [(F.col("client_id"), "_i_client"),
                                        (F.col("claim_invoice_number"), "_i_no")], "item_id")
    matched = F.col("_i_no").isNotNull() & F.col("transaction_number").isNotNull()
    return (j.withColumn("invoice_position", F.when(matched, F.col("_inv_pos").cast("string")))
            .withColumn("invoice_note", F.when(matched, note_text(INVOICE_NOTE_PREFIX,
                                                                   F.col("transaction_number"))))
            .withColumn("transaction_status", F.when(matched, F.lit(TXN_UPDATED)))
            .drop("_i_client", "_i_no", "_inv_pos"))
