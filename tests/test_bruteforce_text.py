"""Remittance parsing and the lookback vs direct Python on random input."""

import datetime as dt

from hypothesis import given, settings, strategies as st

from billflow.operators import gates as G
from billflow.operators import remit as R
from billflow.schema import HOSTILE_CHARS

FIELD = st.text(alphabet="AB1 :?/|'*<>\\\"#.", min_size=0, max_size=6)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(FIELD, min_size=1, max_size=8), min_size=1, max_size=20))
def test_parse_sanitise_docname_match_python(spark, rows):
    texts = ["\n".join(fields) for fields in rows]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, row_text string")
    got = {r.item_id: r for r in R.with_doc_name(R.sanitise_names(R.parse_remit_row(df))).collect()}
    for i, t in enumerate(texts):
        want = dict(zip(R.REMIT_FIELDS, t.split("\n")))
        for name in ("payer", "payee"):
            if name in want:
                want[name] = "".join(ch for ch in want[name] if ch not in HOSTILE_CHARS)
        r = got[i].asDict()
        assert r["parse_ok"] == (len(want) == len(R.REMIT_FIELDS))
        assert {f: r[f] for f in R.REMIT_FIELDS} == {f: want.get(f) for f in R.REMIT_FIELDS}
        assert r["doc_name"] == "_".join(want.get(f, "") for f in ("check_no", "payer", "payee", "amount")) + ".pdf"


@settings(max_examples=8, deadline=None)
@given(st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2030, 12, 31)))
def test_lookback_matches_python_dates(spark, asof):
    days = [asof - dt.timedelta(days=d) for d in range(8)]
    df = spark.createDataFrame([(i, d.strftime("%m/%d/%Y") + ", 09:00 AM ET") for i, d in enumerate(days)],
                               "item_id long, date_time string")
    got = sorted(r.item_id for r in G.business_day_lookback(df, asof).collect())
    if asof.isoweekday() == 1:  # Monday: the previous Thursday, Friday and Saturday
        want_days = {asof - dt.timedelta(days=n) for n in (2, 3, 4)}
    else:  # any other day: the day before yesterday
        want_days = {asof - dt.timedelta(days=2)}
    assert all(d.isoweekday() in (4, 5, 6) for d in want_days) or asof.isoweekday() != 1
    assert got == sorted(i for i, d in enumerate(days) if d in want_days)
