"""Queries over sinks, sources, states and small functions: what they write or keep is read again and must be what another engine makes of the tables."""

from __future__ import annotations

import tempfile
from datetime import date
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import numeric
from tidemill.functions import timeaxis as ta
from tidemill.operators import backtest as bt
from tidemill.operators import dataset as ds
from tidemill.operators import features as ft
from tidemill.operators import models
from tidemill.operators import orderbook as ob
from tidemill.operators import parse as ps
from tidemill.operators import sampling as sp
from tidemill.operators.sgd import State
from tidemill.plans.adapters import DAY_BARS, TICKS, book_feed, day_bars, rounded, sql_round, table, ticks
from tidemill.plans.queries import _L0, _L0_NAMES, _RANKED, _TOP, ORACLE_SQL, _scored, query
from tidemill.sources import files
from tidemill.sources.manifest import Manifest, Slices, index_of, promote
from tidemill.sources.scratch import remove, scratch

# --- time ------------------------------------------------------------------


@query("""SELECT event_id, epoch_us(date_trunc('day', ts)) + (event_id % 24) * 3600000000 + (event_id % 60) * 60000000 + (event_id % 7) * 1000000 + event_id % 1000 - 28800000000 AS ts FROM events""")
def combine_date_tick(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    parts = F.struct((F.col("event_id") % 24).alias("hh"), (F.col("event_id") % 60).alias("mm"), (F.col("event_id") % 7).alias("ss"), (F.col("event_id") % 1000).alias("micros"))
    return e.select("event_id", ta.combine_date_tick(F.to_date("ts"), parts).alias("ts"))


@query("""WITH e AS (SELECT event_id, epoch_us(ts) AS us FROM events) SELECT event_id, us + 5400000000 AS later, us - 60000000 AS earlier, us % 60000000 = 0 AS is_boundary, (us - us % 60000000) % 60000000 = 0 AS floor_is FROM e""")
def minute_steps(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", ta.micros("ts").alias("us"))
    at = F.col("us")
    return e.select("event_id", ta.add_minutes(at, 90).alias("later"), ta.add_minutes(at, -1).alias("earlier"), ta.is_minute_boundary(at).alias("is_boundary"), ta.is_minute_boundary(ta.floor_to(at, ta.MINUTE)).alias("floor_is"))


@query("""WITH b AS (SELECT CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS z FROM events), d AS (SELECT unnest(generate_series(a, z, INTERVAL 1 DAY)) AS d, a, z FROM b)
    SELECT strftime(d, '%Y-%m-%d') AS day, strftime(DATE '2030-01-01' + CAST(date_diff('day', a, d) AS INTEGER), '%Y-%m-%d') AS moved FROM d""")
def day_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """All days from the first event to the last, and each as far from 2030-01-01 as it is from the first."""
    first, last = (date.fromisoformat(x) for x in table(spark, sf, "events").agg(F.date_format(F.min("ts"), "yyyy-MM-dd"), F.date_format(F.max("ts"), "yyyy-MM-dd")).first())
    rows = [(ta.resolve_date(d.isoformat()), ta.shift_date(d, first, date(2030, 1, 1)).isoformat()) for d in ta.days_between(first, last)]
    return spark.createDataFrame(rows, "day string, moved string")


# --- rows and columns ------------------------------------------------------


@query("""SELECT CAST(user_id AS VARCHAR) AS symbol, epoch_us(ts) AS ts, event_type AS event, event_id AS order_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'B' END AS side, value AS price, event_id % 100 AS volume, event_id * 2 AS buy_no, event_id * 2 + 1 AS sell_no FROM events""")
def row_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    text = lambda c: c.cast("string")
    rows = e.select(F.col("user_id").alias("symbol"), text(ta.micros("ts")).alias("ts"), F.col("event_type").alias("fact_dir"), text(F.col("event_id")).alias("order_id"), F.when(F.col("event_id") % 3 != 0, "B").alias("side"), text(F.col("value")).alias("price"), text(F.col("event_id") % 100).alias("volume"), text(F.col("event_id") * 2).alias("buy_no"), text(F.col("event_id") * 2 + 1).alias("sell_no"))
    return ps.row_events(rows)


@query(f"""WITH {TICKS} SELECT symbol, seq, least(greatest(price, 10.0), 150.0) AS clipped, lag(price) OVER (PARTITION BY symbol ORDER BY ts, seq) AS before, lpad(symbol, CAST(greatest(6, length(symbol)) AS INTEGER), '0') AS padded FROM t""")
def small_columns(spark: SparkSession, sf: str) -> DataFrame:
    return ticks(spark, sf).select("symbol", "seq", numeric.clip(F.col("price"), 10.0, 150.0).alias("clipped"), numeric.shift_1("price", "symbol", "ts", "seq").alias("before"), numeric.padded_symbol(F.col("symbol")).alias("padded"))


@query(f"WITH {DAY_BARS}, {_L0} SELECT symbol, ts, close, {', '.join(sql_round(c, c) for c in _L0_NAMES)} FROM l0")
def feature_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Features made elsewhere come to a table of bars by key, over stale ones; its own columns stay."""
    made = ft.l0(day_bars(spark, sf)).withColumn("close", F.lit(-1.0))
    base = day_bars(spark, sf).select("symbol", "ts", "close").withColumn("l0_amount", F.lit(-1.0))
    return rounded(ft.merge_features(base, made).select("symbol", "ts", "close", *_L0_NAMES), only=_L0_NAMES)


@query("""SELECT flags, unnest(CASE flags WHEN 'all' THEN ['ts', 'trade_date', 'minute', 'open', 'high', 'low', 'close', 'volume', 'notional', 'trade_count', 'l0_amount', 'l0_avg_trade_size', 'l0_range', 'l0_abs_move', 'l0_log_volume', 'l0_log_trade_count', 'l1_ret_w5_1']
    WHEN 'no l0' THEN ['ts', 'trade_date', 'minute', 'open', 'high', 'low', 'close', 'volume', 'notional', 'trade_count', 'l1_ret_w5_1'] ELSE ['ts', 'trade_date', 'minute', 'open', 'high', 'low', 'close', 'volume', 'notional', 'trade_count'] END) AS name FROM (VALUES ('all'), ('no l0'), ('neither')) x(flags)""")
def candidate_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = ft.l0(day_bars(spark, sf)).withColumns({"l1_ret_w5_1": F.lit(0.0), "l1_z_w5_close": F.lit(0.0)})
    rows = [(flags, c) for flags, l0, l1 in (("all", True, True), ("no l0", False, True), ("neither", False, False)) for c in ft.z_columns(df, l0=l0, l1=l1)]
    return spark.createDataFrame(rows, "flags string, name string")


# --- models ----------------------------------------------------------------

_LINE = "0.5 + 2.0 * coalesce(p_size, 0) - 0.25 * CASE WHEN p_size % 7 = 0 THEN 0.0 ELSE p_retailprice END"


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice")).alias("price"))


@query(f"SELECT p_partkey, {sql_round(_LINE, 'score')}, CASE WHEN {_LINE} > -100 THEN 3 ELSE 0 END::BIGINT AS target FROM part")
def linear_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A published model, found by a strategy's configuration, as a column; and the strategy that the configuration names."""
    with tempfile.TemporaryDirectory() as folder:
        State(["size", "price"], weights=[2.0, -0.25], intercept=0.5).save(f"{folder}/run")
        state = models.inference({"artifact": models.resolve_artifact(promote(f"{folder}/run", f"{folder}/models", "line", "v1"))})
    target = bt.Strategies.build({"type": "threshold", "threshold": -100, "qty": 3})(state.score())
    return rounded(_parts(spark, sf).select("p_partkey", state.score().alias("score"), target.alias("target")))


@query(f"SELECT p_partkey, {sql_round('1 / (1 + exp(-(0.05 * p_size - 0.001 * CASE WHEN p_size % 7 = 0 THEN 0.0 ELSE p_retailprice END)))', 'probability')} FROM part")
def library_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A model of the kind that libraries have."""

    class Logistic:
        def predict_proba(self, x: np.ndarray) -> np.ndarray:
            p = 1 / (1 + np.exp(-(x @ np.array([0.05, -0.001]))))
            return np.column_stack([1 - p, p])

    return rounded(_parts(spark, sf).select("p_partkey", models.model_score(Logistic(), ["size", "price"]).alias("probability")))


@query("""WITH s AS (SELECT strftime(l_shipdate, '%Y-%m') AS update_day, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS y, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS p, round(l_extendedprice, -2) AS s FROM lineitem),
    r AS (SELECT *, rank() OVER (PARTITION BY update_day ORDER BY s) + (count(*) OVER (PARTITION BY update_day, s) - 1) / 2 AS rk FROM s),
    m AS (SELECT update_day, count(*) AS n, sum(y) AS pos, avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS accuracy, coalesce(2.0 * sum(y * p) / nullif(sum(y) + sum(p), 0), 0.0) AS f1, (sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * (count(*) - sum(y)), 0) AS auc FROM r GROUP BY update_day)
    SELECT update_day, update_day AS model_asof_day, n, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(auc, 6) AS auc FROM m""")
def daily_reports(spark: SparkSession, sf: str) -> DataFrame:
    """A report in JSON for each day, written and read again."""
    rows = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("update_day"), (F.col("l_quantity") > 25).cast("int").alias("label"), (F.col("l_discount") > 0.05).cast("int").alias("predicted"), F.round("l_extendedprice", -2).alias("score"))
    out = scratch(spark)
    files.write_reports(ds.daily_reports(rows, by=["update_day"]), out)
    back = spark.read.schema("model_asof_day string, metrics struct<n: long, accuracy: double, f1: double, auc: double>, update_day string").json(out)
    return rounded(back.select("update_day", "model_asof_day", "metrics.*"))


@query("""WITH s AS (SELECT event_id, floor(value) AS s FROM events) SELECT event_id, CAST(rank() OVER (ORDER BY s) AS DOUBLE) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS place FROM s""")
def global_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return ds.global_rank(table(spark, sf, "events").select("event_id", F.floor("value").cast("double").alias("s")), "s", "place").select("event_id", "place")


# --- sinks and sources -----------------------------------------------------

_EVENTS = "SELECT event_id, user_id, event_type, value FROM events"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")


@query(_EVENTS)
def sink_append(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks added to a table whose schema the first one fixed; another schema is an error."""
    e, out = _events(spark, sf), scratch(spark)
    for k in range(3):
        files.append(e.where(F.col("event_id") % 3 == k), out)
    try:
        files.append(e.withColumn("value", F.col("value").cast("string")), out)
    except ValueError:
        return spark.read.parquet(out)
    raise RuntimeError("another schema was taken")


@query(_EVENTS)
def sink_once(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch(spark)
    files.write_once(_events(spark, sf), out)
    try:
        files.write_once(_events(spark, sf).limit(1), out)
    except FileExistsError:
        return spark.read.parquet(out)
    raise RuntimeError("a table was written over")


@query(ORACLE_SQL["book_events"])
def sink_events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Book events that arrive as a stream, into a table batch by batch."""
    feed, into, out, mark = book_feed(spark, sf), scratch(spark), scratch(spark), scratch(spark)
    for k in range(2):
        feed.where(F.col("order_id") % 2 == k).write.mode("append").parquet(into)
        files.stream_to(ob.book_events(spark.readStream.schema(feed.schema).parquet(into)), out, mark).awaitTermination()
    remove(spark, into, mark)
    return spark.read.parquet(out)


@query(_TOP)
def sink_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch(spark)
    files.write(ob.snapshot(book_feed(spark, sf)), out, order=["symbol", "side", "level"])
    return files.read(spark, out, ob.SNAPSHOT.names)


@query(f"WITH {_RANKED} SELECT eval_day, {sql_round('ic', 'rank_ic')}, n FROM c")
def sink_series(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch(spark)
    files.write_series(rounded(ds.rank_ic(_scored(spark, sf))).orderBy("eval_day"), out)
    return spark.read.schema("eval_day string, rank_ic double, n long").option("header", True).csv(out)


@query(f"WITH {_RANKED} SELECT count(*) + 0 AS days, CASE WHEN count(*) < 5 THEN 0 ELSE count(*) - 4 END AS means FROM c")
def charts(spark: SparkSession, sf: str) -> DataFrame:
    """Daily and rolling rank IC as charts: how many points each has."""
    ic = ds.rank_ic(_scored(spark, sf))
    with tempfile.TemporaryDirectory() as folder:
        points = []
        for rolling in (None, 5):
            text = Path(files.plot_series(ic, f"{folder}/x.svg", rolling=rolling)).read_text()
            points.append(len(text.split('points="')[1].split('"')[0].split()))
    return spark.createDataFrame([tuple(points)], "days long, means long")


@query("SELECT event_id, user_id FROM events WHERE event_type IN ('view', 'click')")
def sources_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Only files that a pattern matches, and only the columns asked for."""
    out = scratch(spark)
    for kind in ("view", "click", "error"):
        files.write_once(_events(spark, sf).where(F.col("event_type") == kind), f"{out}/{'keep' if kind != 'error' else 'leave'}-{kind}")
    parts = [files.read(spark, f"{out}/keep-{k}", ["event_id", "user_id"], glob="*.parquet") for k in ("view", "click")]
    return parts[0].unionByName(parts[1])


@query("SELECT 'feature.a.parquet' AS feature, 'label.a.parquet' AS label UNION ALL SELECT 'feature.c.parquet', 'label.c.parquet'")
def matched_files(spark: SparkSession, sf: str) -> DataFrame:
    pairs = ds.match_files(["feature.c.parquet", "feature.a.parquet", "feature.b.parquet", "x.d.parquet"], ["label.a.parquet", "label.c.parquet", "label.z.parquet"])
    return spark.createDataFrame(pairs, "feature string, label string")


@query("SELECT event_id FROM events ORDER BY event_id DESC LIMIT 50")
def last_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The last lines of a text file that is read from its end."""
    out = scratch(spark)
    table(spark, sf, "events").select(F.col("event_id").cast("string").alias("value")).orderBy(F.col("event_id")).coalesce(1).write.text(out)
    (path,) = [f.getPath().toString() for f in _listing(spark, out) if f.getPath().getName().startswith("part-")]
    return spark.createDataFrame([(int(x),) for x in files.tail(spark, path, 50)], "event_id long")


def _listing(spark: SparkSession, path: str) -> list:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return list(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where))


# --- manifests -------------------------------------------------------------


@query("SELECT * FROM (VALUES ('no manifest', true), ('nothing new', false), ('another source', true), ('committed again', false), ('output gone', true)) x(state, must_run)")
def manifest_states(spark: SparkSession, sf: str) -> DataFrame:
    rows = []
    with tempfile.TemporaryDirectory() as folder:
        source, output = Path(folder, "in"), Path(folder, "out")
        source.write_text("x")
        output.write_text("made")
        m = Manifest(folder, "stage", "slot")
        note = lambda state: rows.append((state, m.changed(source)))
        note("no manifest")
        m.commit(source, output, 1)
        note("nothing new")
        source.write_text("xy")
        note("another source")
        m.commit(source, output, 1)
        note("committed again")
        output.unlink()
        note("output gone")
    return spark.createDataFrame(rows, "state string, must_run boolean")


@query(f"WITH {TICKS} SELECT symbol, ts, seq, price FROM t WHERE symbol IN (SELECT symbol FROM t GROUP BY symbol ORDER BY symbol LIMIT 3)")
def manifest_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Symbols read by the index that was committed with a table."""
    out = scratch(spark)
    files.write(ticks(spark, sf).select("symbol", "ts", "seq", "price"), out, order=["symbol", "ts", "seq"])
    df = spark.read.parquet(out)
    with tempfile.TemporaryDirectory() as folder:
        m = Manifest(folder, "trade", "all")
        m.commit(folder, folder, df.count(), index_of(df))
        slices = Slices(m, df)
    some = [slices.get(s) for s in slices.symbols()[:3]]
    return some[0].unionByName(some[1]).unionByName(some[2])


@query(f"""WITH {TICKS}, f AS (SELECT DISTINCT CASE WHEN seq % 2 = 0 THEN 'even' ELSE 'odd' END AS file, symbol FROM t), l AS (SELECT DISTINCT CASE WHEN seq % 2 = 0 THEN 'even' ELSE 'odd' END AS file, symbol FROM t WHERE price > 1),
    p AS (SELECT file, symbol FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY md5('42:' || symbol), symbol) AS n FROM (SELECT * FROM f INTERSECT SELECT * FROM l)) WHERE n <= 5)
    SELECT p.file, t.symbol, t.seq, strftime(make_timestamp(t.ts) + INTERVAL 7 DAY, '%Y-%m-%d') AS day FROM t JOIN p ON p.symbol = t.symbol AND p.file = CASE WHEN t.seq % 2 = 0 THEN 'even' ELSE 'odd' END""")
def pool_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Five symbols a file, and their rows with days moved on."""
    t = ticks(spark, sf).select(F.when(F.col("seq") % 2 == 0, "even").otherwise("odd").alias("file"), "symbol", "seq", "price", F.date_from_unix_date(ta.epoch_day(F.col("ts")).cast("int")).alias("day"))
    out = sp.rows_of_pools(t, sp.symbol_pools(t, t.where("price > 1"), 5), day="day", shift=7)
    return out.select("file", "symbol", "seq", F.date_format("day", "yyyy-MM-dd").alias("day"))
