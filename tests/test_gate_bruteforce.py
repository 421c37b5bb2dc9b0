"""Gates vs a brute-force Python model of the source's masks, on random rows.

The model follows the pandas filters row by row (the service starts with a
listed code and a colon, `!=` keeping missing values), with the two documented divergences: a
missing service never raises (counts as no match) and an empty code list
matches any present service.
"""

from hypothesis import given, settings, strategies as st

from billflow.operators import gates as G
from billflow.sources.rules import rules_from_lists

STATUSES = [None, "Kept", "Late Cancel", "No Show", "Canceled", "Other"]
SERVICES = [None, "993: a", "90837: b", "999:", "993", "x: 993", "90791: c"]
BILLED = [None, "Yes", "No"]
CODES = ["993", "90837", "90791", "999"]
RULE_OF = {"No Show": "no_show_cpts", "Late Cancel": "late_cancel_cpts", "Kept": "kept_cpts"}


def matches(service, codes):
    if service is None:
        return False
    return not codes or any(service.startswith(c + ":") for c in codes)


def model(rows, rules):
    opened, exc = [], []
    for i, (billed, status, service) in enumerate(rows):
        excluded = status is not None and status in rules["exclude_status"]
        m = {s: matches(service, rules[r]) for s, r in RULE_OF.items()}
        if billed != "Yes":
            if not excluded and all(status != s or m[s] for s in RULE_OF):
                opened.append(i)
        else:
            keep = not excluded
            keep &= not (status == "No Show" and m["No Show"])
            keep &= not (status == "Late Cancel" and m["Late Cancel"])
            keep &= status != "Kept" or m["Kept"]
            if keep:
                exc.append(i)
    return opened, exc


rows_st = st.lists(st.tuples(st.sampled_from(BILLED), st.sampled_from(STATUSES),
                             st.sampled_from(SERVICES)), min_size=1, max_size=40)
rules_st = st.fixed_dictionaries({
    "exclude_status": st.lists(st.sampled_from(["Canceled", "Other"]), max_size=2, unique=True),
    "no_show_cpts": st.lists(st.sampled_from(CODES), max_size=2, unique=True),
    "late_cancel_cpts": st.lists(st.sampled_from(CODES), max_size=2, unique=True),
    "kept_cpts": st.lists(st.sampled_from(CODES), max_size=2, unique=True),
})


@settings(max_examples=12, deadline=None)
@given(rows_st, rules_st)
def test_gates_match_bruteforce(spark, rows, rules):
    df = spark.createDataFrame([(i, b, s, v) for i, (b, s, v) in enumerate(rows)],
                               "item_id long, is_billed string, status string, service_type string")
    r = rules_from_lists(spark, rules)
    got_open = sorted(x.item_id for x in G.code_gate(G.status_exclusion(G.open_rows(df), r), r)
                      .select("item_id").collect())
    got_exc = sorted(x.item_id for x in G.billed_exception_gate(G.billed_rows(df), r)
                     .select("item_id").collect())
    want_open, want_exc = model(rows, rules)
    assert got_open == want_open
    assert got_exc == want_exc
