"""Queries whose registered SQL leaves rows out: the whole job against a plain version."""

import pytest

import __spark_entry__ as entry
from tidemill.operators.backtest import INITIAL_CASH

SF = "/root/testdata/sf0.001"
MINUTE, HOUR = 60_000_000, 3_600_000_000


@pytest.fixture(scope="module")
def replayed(spark):
    """A plain replay: each symbol's price at each hour, the targets, and what is bought and sold."""
    from tidemill.plans.adapters import ticks

    events = sorted((r.ts, r.seq, r.symbol, r.price) for r in ticks(spark, SF).select("ts", "seq", "symbol", "price").collect())
    clock = range(events[0][0] - events[0][0] % MINUTE, events[-1][0] + 1, HOUR)
    symbols, last, k = sorted({e[2] for e in events}), {}, 0
    held, cash, targets, fills, curve = dict.fromkeys(symbols, 0), INITIAL_CASH, {}, [], []
    for ts in clock:
        while k < len(events) and events[k][0] <= ts:
            last[events[k][2]] = events[k][3]
            k += 1
        price = {s: p for s, p in last.items() if p > 20}
        curve.append((ts, cash, cash + sum(held[s] * p for s, p in price.items())))
        for s in symbols:
            score = last[s] - 100 if s in last else None
            targets[s, ts] = (3 if score is not None and score > 0 else 0, 2 if score is not None and score / 1000 + 0.5 >= 0.5 else 0)
            change = targets[s, ts][0] - held[s]
            if ts % MINUTE == 0 and s in price and change:
                fills.append((ts, s, "BUY" if change > 0 else "SELL", abs(change), price[s]))
                held[s] += change
                cash -= change * price[s]
    return symbols, targets, fills, curve, held, cash


def test_replay_has_every_symbol(spark, replayed):
    symbols, targets, fills, curve, held, cash = replayed
    run = lambda name: entry.queries()[name](spark, SF).collect()
    assert sorted((r.symbol, r.ts) for r in run("replay_grid")) == sorted(targets)
    assert {(r.symbol, r.ts): (r.target, r.prob_target) for r in run("threshold_targets")} == targets
    assert sorted((r.ts, r.symbol, r.side, r.qty, r.price) for r in run("fills")) == sorted(fills)
    got = sorted((r.ts, r.cash, r.equity) for r in run("equity_curve"))
    assert len(got) == len(curve) and all(a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-3) for a, b in zip(got, curve, strict=True))
    report = run("backtest_report")
    assert {r.symbol: r.qty for r in report} == held and all(r.final_cash == pytest.approx(cash, abs=1e-3) for r in report)


def test_tick_parts_of_all_rows(spark):
    from tidemill.plans.adapters import raw_feed

    def plain(t):
        s = str(t // 100 * 1000 + t % 100)
        if not 7 <= len(s) <= 9:
            return None, None, None, None
        s = f"0{s}" if len(s) != 9 and s[0] == "9" else s
        s = f"{s}0" if len(s) != 9 else s
        return int(s[:-7]), int(s[-7:-5]), int(s[-5:-3]), int(s[-3:])

    want = {int(r.SubSeq): plain(int(r.TickTime)) for r in raw_feed(spark, SF).select("SubSeq", "TickTime").collect()}
    got = entry.queries()["tick_parts"](spark, SF).collect()
    assert len(got) == len(want) and {r.event_id: (r.hh, r.mm, r.ss, r.mmm) for r in got} == want


def test_fwd_return_keeps_bars_at_zero(spark, monkeypatch):
    from tidemill.plans import queries

    bars = spark.createDataFrame([("a", k, c) for k, c in enumerate([2.0, 0.0, 3.0, 0.0, 0.0])], "symbol string, ts long, close double")
    monkeypatch.setattr(queries, "hour_bars", lambda spark, sf: bars)
    got = {r.ts: str(r.label_fwd_ret_s1) for r in queries.fwd_return(spark, SF).collect()}
    assert got == {0: "-1.0", 1: "inf", 2: "-1.0", 3: "nan", 4: "None"}


def against_sql(spark, monkeypatch, name, feed):
    """Rows of a query over events of one user, (microseconds, value), and of its SQL, by ts."""
    import duckdb
    import pyarrow as pa

    from tidemill.plans import adapters

    table = pa.table({"event_id": list(range(len(feed))), "ts": pa.array([t for t, _ in feed], pa.timestamp("us")), "user_id": [1] * len(feed), "event_type": ["click"] * len(feed), "value": pa.array([v for _, v in feed], pa.float64())})
    events = spark.createDataFrame([(r["event_id"], r["ts"], 1, "click", r["value"]) for r in table.to_pylist()], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    monkeypatch.setattr(adapters, "table", lambda spark, sf, of: events)
    con = duckdb.connect()
    con.register("events", table)
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = {r["ts"]: r for r in (dict(zip(names, x, strict=True)) for x in found.fetchall())}
    got = {r.ts: r.asDict() for r in entry.queries()[name](spark, SF).collect()}
    return got, want


ZERO_CLOSES = [5.0, 7.0, 6.0, 9.0, 8.0, 5.0, 4.0, 0.0, 3.0, 4.0, 0.0, 0.0, 6.0]


def test_feature_chain_scores_an_infinite_return_as_sql_does(spark, monkeypatch):
    got, want = against_sql(spark, monkeypatch, "feature_chain", [(k * 24 * HOUR, v) for k, v in enumerate(ZERO_CLOSES)])
    assert sorted(got) == sorted(want) and all(str(got[k][c]) == str(want[k][c]) for k in want for c in want[k])
    assert [r["l1_z_w5_l1_ret_w5_1"] for _, r in sorted(got.items())].count(float("inf")) == 1


def test_fwd_logret_is_null_at_zero_as_in_sql(spark, monkeypatch):
    got, want = against_sql(spark, monkeypatch, "fwd_logret", [(k * HOUR, v) for k, v in enumerate(ZERO_CLOSES)])
    assert {k: r["label_fwd_logret_s5"] for k, r in got.items()} == {k: r["label_fwd_logret_s5"] for k, r in want.items()}
    assert [r["label_fwd_logret_s5"] is None for _, r in sorted(got.items())] == [False, False, True, False, False, True, True, True, *[True] * 5]
