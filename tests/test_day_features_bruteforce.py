"""Day-table features against a brute-force Python computation on random data."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from martforge.operators.features import engineer_features
from martforge.schemas import HOLIDAYS


def _round2(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_random_days_match_brute_force(spark):
    rnd = random.Random(7)
    start = dt.date(2015, 1, 1)
    rows = []
    for i in range(400):
        d = None if rnd.random() < 0.05 else start + dt.timedelta(days=rnd.randrange(0, 900))
        sales = None if rnd.random() < 0.03 else round(rnd.uniform(0, 500), 2)
        rows.append((i, None, d, sales, 1.0))
    hdays = sorted({start + dt.timedelta(days=rnd.randrange(-30, 930)) for _ in range(25)})
    holidays = [("Thanksgiving Day" if h.month == 11 else "Other", h) for h in hdays]
    df = spark.createDataFrame(rows, "id int, holiday_name string, `Order Date` date, Sales double, Profit double")
    got = {r.id: r for r in engineer_features(df, spark.createDataFrame(holidays, HOLIDAYS)).collect()}

    totals = {}
    for _, _, d, s, _ in rows:
        if d is not None:
            totals.setdefault(d, []).append(s)
    daily = {d: (sum(round(v * 10000) for v in vs if v is not None) if any(v is not None for v in vs) else None)
             for d, vs in totals.items()}
    tg = {}
    for name, h in holidays:
        if name == "Thanksgiving Day":
            tg[h.year] = max(tg.get(h.year, h), h)

    def rolling(d, span):
        vals = [u for day, u in daily.items() if u is not None and 0 <= (d - day).days < span]
        return _round2(sum(vals) / 10000.0 / len(vals)) if vals else None

    for i, _, d, _, _ in rows:
        r = got[i]
        if d is None:
            assert (r.days_until_next_holiday, r.days_since_last_holiday, r.rolling_sales_7d,
                    r.holiday_shopping_season_flag) == (None, None, None, 0)
            continue
        nxt = [h for h in hdays if h >= d]
        prv = [h for h in hdays if h <= d]
        assert r.days_until_next_holiday == ((nxt[0] - d).days if nxt else None)
        assert r.days_since_last_holiday == ((d - prv[-1]).days if prv else None)
        season = 1 if d.year in tg and tg[d.year] <= d <= dt.date(d.year, 12, 25) else 0
        assert r.holiday_shopping_season_flag == season
        assert r.rolling_sales_7d == rolling(d, 7)
        assert r.rolling_sales_30d == rolling(d, 30)
