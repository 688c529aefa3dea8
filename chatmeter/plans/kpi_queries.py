"""Registered queries: cleaning, PV, users, QPS, overall figures and corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmeter.operators import kpi, maintain
from chatmeter.operators.clean import clean_events
from chatmeter.plans import jobs
from chatmeter.plans import registry as r
from chatmeter.plans.registry import query
from chatmeter.session import materialize, scratch_dir
from chatmeter.sources import testtables
from chatmeter.sources.readers import read_lines
from chatmeter.sources.sinks import write_text
from chatmeter.sources.store import KpiStore


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.table(spark, sf_dir, "events")


def _clean(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return clean_events(testtables.log_lines(_events(spark, sf_dir)), **options)


def _clean_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the batch jobs clean: with ids stripped."""
    return _clean(spark, sf_dir, strip_ids=True)


def _clean_today(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return _clean(spark, sf_dir, check_time=False, day_mode="processing", as_of=r.AS_OF, **options)


# --- cleaning -----------------------------------------------------------------------------------


@query(r.STRICT + "SELECT * FROM strict", name="clean_events")
def clean_events_strict(spark, sf_dir):
    return _clean(spark, sf_dir)


@query(r.LOOSE + f"SELECT product, bot_name, user_id, DATE '{r.AS_OF}' AS day, second FROM loose")
def clean_events_no_time(spark, sf_dir):
    return _clean_today(spark, sf_dir)


@query(r.CASED + f"SELECT product, bot_name, user_id, DATE '{r.AS_OF}' AS day, second FROM cased")
def clean_events_case_sensitive(spark, sf_dir):
    return _clean_today(spark, sf_dir, ignore_case=False)


# --- page views ---------------------------------------------------------------------------------


@query(r.STRICT + "SELECT bot_name, count(*) AS pv FROM strict GROUP BY bot_name")
def kpi_pv_total(spark, sf_dir):
    return kpi.pv_total(_clean_batch(spark, sf_dir))


@query(r.STRICT + "SELECT bot_name, day, count(*) AS pv FROM strict GROUP BY bot_name, day")
def kpi_pv_day(spark, sf_dir):
    return kpi.pv_day(_clean(spark, sf_dir))


@query(r.CASED + f"SELECT bot_name, DATE '{r.AS_OF}' AS day, count(*) AS pv FROM cased GROUP BY bot_name")
def kpi_pv_day_processing(spark, sf_dir):
    return kpi.pv_day(_clean_today(spark, sf_dir, ignore_case=False))


@query(
    r.LOOSE + """SELECT target, bot_name, count(*) AS pv
    FROM loose CROSS JOIN (VALUES ('pv_total'), ('pv_history')) AS t(target) GROUP BY target, bot_name"""
)
def pv_live_and_history(spark, sf_dir):
    pv = kpi.pv_total(_clean(spark, sf_dir, check_time=False))
    return kpi.to_counters(pv, ("pv_total", "pv_history"))


@query("SELECT event_type AS bot_name, count(*) AS pv FROM events GROUP BY event_type")
def pv_history_raw(spark, sf_dir):
    """From text files, as the extracted ones are."""
    path = scratch_dir(spark, "extracted")
    write_text(testtables.extracted_lines(_events(spark, sf_dir)), path)
    return kpi.pv_extracted(read_lines(spark, path))


@query(
    r.LOOSE + """, fresh AS (SELECT event_type AS bot_name, count(*) AS pv FROM events
      WHERE event_type IN ('click', 'purchase') GROUP BY event_type)
    SELECT bot_name, pv FROM fresh
    UNION ALL SELECT bot_name, count(*) AS pv FROM loose
      WHERE bot_name NOT IN (SELECT bot_name FROM fresh) GROUP BY bot_name"""
)
def pv_history_overwrite(spark, sf_dir):
    """The extracted file holds the bots of one type; the others keep the stored value."""
    store, root, logs = _store(spark, sf_dir, "overwrite")
    jobs.backfill_pv(store, logs, "pv")
    some = _events(spark, sf_dir).where(F.col("event_type").isin("click", "purchase"))
    write_text(testtables.extracted_lines(some), f"{root}/extracted")
    for _ in range(2):
        jobs.rebuild_history(store, f"{root}/extracted", "extract")
    return store.pv_history()


@query(
    r.STRICT + """SELECT bot_name, CAST(sum(pv) AS BIGINT) AS pv FROM (
      SELECT bot_name, count(*) AS pv FROM strict GROUP BY bot_name
      UNION ALL SELECT event_type AS bot_name, count(*) AS pv FROM events GROUP BY event_type) GROUP BY bot_name"""
)
def pv_history_merge(spark, sf_dir):
    """History added to the live counters, twice; the second time changes nothing."""
    store, root, logs = _store(spark, sf_dir, "merge")
    jobs.backfill_totals(store, logs, "totals")
    write_text(testtables.extracted_lines(_events(spark, sf_dir)), f"{root}/extracted")
    jobs.rebuild_history(store, f"{root}/extracted", "extract")
    for _ in range(2):
        jobs.merge_history(store)
    return store.pv_total()


# --- users --------------------------------------------------------------------------------------


@query(r.STRICT + "SELECT DISTINCT bot_name, user_id FROM strict")
def users_total(spark, sf_dir):
    return kpi.users_total(_clean_batch(spark, sf_dir))


@query(r.STRICT + "SELECT DISTINCT bot_name, day, user_id FROM strict")
def users_day(spark, sf_dir):
    return kpi.users_day(_clean(spark, sf_dir))


def _stored_and_incoming(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Daily visits before and from a day on; the log is read and parsed once for both."""
    visits = materialize(spark, kpi.users_day(_clean_batch(spark, sf_dir)), "visits")
    boundary = F.lit(r.STORED_UNTIL).cast("date")
    return visits.where(F.col("day") < boundary), visits.where(F.col("day") >= boundary)


@query(r.STRICT + "SELECT DISTINCT bot_name, user_id FROM strict")
def users_total_merge(spark, sf_dir):
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    return kpi.merge_users(kpi.users_total(stored), incoming)


@query(
    r.STRICT + f", {r.FIRST_SEEN} SELECT bot_name, day, user_id FROM first_seen WHERE day >= DATE '{r.STORED_UNTIL}'"
)
def new_users_day(spark, sf_dir):
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    return kpi.new_users(incoming, known=kpi.users_total(stored))


@query(
    r.STRICT + f", {r.FIRST_SEEN} SELECT DISTINCT bot_name FROM first_seen WHERE day >= DATE '{r.STORED_UNTIL}'"
)
def bot_registry(spark, sf_dir):
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    return kpi.bot_registry(kpi.new_users(incoming, known=kpi.users_total(stored)))


@query(r.STRICT + "SELECT bot_name, count(DISTINCT user_id) AS uv FROM strict GROUP BY bot_name")
def kpi_uv_total(spark, sf_dir):
    return kpi.uv_total(kpi.users_total(_clean_batch(spark, sf_dir)))


@query(r.STRICT + "SELECT bot_name, day, count(DISTINCT user_id) AS uv FROM strict GROUP BY bot_name, day")
def kpi_uv_day(spark, sf_dir):
    return kpi.uv_day(kpi.users_day(_clean(spark, sf_dir)))


@query(r.STRICT + f", {r.FIRST_SEEN} SELECT bot_name, day, count(*) AS uv FROM first_seen GROUP BY bot_name, day")
def kpi_new_uv_day(spark, sf_dir):
    return kpi.uv_day(kpi.new_users(_clean_batch(spark, sf_dir)))


# --- requests per second ------------------------------------------------------------------------

_QPS_BOT = "SELECT bot_name, day, second, count(*) AS requests FROM {source} GROUP BY bot_name, day, second"
_QPS_PRODUCT = "SELECT product, day, second, count(*) AS requests FROM strict GROUP BY product, day, second"
_TOP = """, qps AS ({qps}) SELECT {key}, day, requests, second FROM (
  SELECT *, row_number() OVER (PARTITION BY {key}, day ORDER BY requests DESC, second) AS place FROM qps)
  WHERE place = 1"""


@query(r.STRICT + _QPS_BOT.format(source="strict"))
def kpi_qps_bot(spark, sf_dir):
    return kpi.qps_bot(_clean(spark, sf_dir))


@query(r.STRICT + _QPS_PRODUCT)
def kpi_qps_product(spark, sf_dir):
    return kpi.qps_product(_clean(spark, sf_dir))


@query(
    r.CASED + f"""SELECT bot_name, DATE '{r.AS_OF}' AS day, second, count(*) AS requests
    FROM cased GROUP BY bot_name, second"""
)
def qps_raw_text(spark, sf_dir):
    return kpi.qps_bot(_clean_today(spark, sf_dir, ignore_case=False))


@query(r.STRICT + _TOP.format(key="bot_name", qps=_QPS_BOT.format(source="strict")))
def top_qps_bot(spark, sf_dir):
    return kpi.busiest_first(kpi.top_qps(kpi.qps_bot(_clean(spark, sf_dir)), "bot_name"))


@query(r.STRICT + _TOP.format(key="product", qps=_QPS_PRODUCT))
def top_qps_product(spark, sf_dir):
    return kpi.busiest_first(kpi.top_qps(kpi.qps_product(_clean(spark, sf_dir)), "product"))


# --- over all bots ------------------------------------------------------------------------------


@query(
    r.STRICT + """SELECT CAST(sum(pv) AS BIGINT) AS pv, CAST(sum(uv) AS BIGINT) AS uv FROM (
      SELECT bot_name, count(*) AS pv, count(DISTINCT user_id) AS uv FROM strict GROUP BY bot_name)"""
)
def overall_totals(spark, sf_dir):
    return kpi.overall_totals(_clean_batch(spark, sf_dir))


@query(
    r.STRICT + f""", {r.FIRST_SEEN}
    SELECT d.day, d.pv, d.uv, CAST(coalesce(n.new_uv, 0) AS BIGINT) AS new_uv
    FROM (SELECT day, count(*) AS pv, count(DISTINCT (bot_name, user_id)) AS uv FROM strict GROUP BY day) d
    LEFT JOIN (SELECT day, count(*) AS new_uv FROM first_seen GROUP BY day) n ON n.day = d.day"""
)
def overall_by_day(spark, sf_dir):
    return kpi.overall_by_day(_clean(spark, sf_dir))


# --- jobs on a store: log text in, tables out ---------------------------------------------------


def _store(spark, sf_dir, name: str) -> tuple[KpiStore, str, str]:
    """An empty store, its scratch folder, and the log as text files beside it."""
    root = scratch_dir(spark, name)
    testtables.log_lines(_events(spark, sf_dir)).select("value").write.text(f"{root}/logs")
    return KpiStore(spark, f"{root}/store"), root, f"{root}/logs"


def _days(spark, sf_dir, name: str) -> tuple[KpiStore, str]:
    store, _, logs = _store(spark, sf_dir, name)
    jobs.backfill_days(store, logs, "days")
    return store, logs


@query(r.STRICT + "SELECT bot_name, user_id FROM strict GROUP BY bot_name, user_id")
def job_backfill_totals(spark, sf_dir):
    store, _, logs = _store(spark, sf_dir, "totals")
    jobs.backfill_totals(store, logs, "totals")
    return store.users_total()


@query(r.STRICT + f", {r.FIRST_SEEN} SELECT bot_name, day, user_id FROM first_seen")
def job_backfill_days(spark, sf_dir):
    """Run twice under its name, and once more under another, which brings no new user."""
    store, logs = _days(spark, sf_dir, "days")
    jobs.backfill_days(store, logs, "days")
    jobs.backfill_days(store, logs, "again")
    return store.new_users_day()


@query(r.LOOSE + "SELECT bot_name, 2 * count(*) AS pv FROM loose GROUP BY bot_name")
def job_backfill_pv(spark, sf_dir):
    """Live counters after the history was merged into them, twice."""
    store, _, logs = _store(spark, sf_dir, "pv")
    jobs.backfill_pv(store, logs, "pv")
    for _ in range(2):
        jobs.merge_history(store)
    return store.pv_total()


@query(r.STRICT + "SELECT bot_name, 3 * count(*) AS pv FROM strict GROUP BY bot_name")
def job_compact(spark, sf_dir):
    """Three runs, each compacted, one repeated afterwards; data without a reference deleted."""
    store, logs = _days(spark, sf_dir, "compact")
    for job in ("second", "third", "second"):
        jobs.backfill_days(store, logs, job)
        store.compact(job, "job")
    store.vacuum(hours=0)
    return store.pv_total()


@query(
    r.STRICT + f", {r.FIRST_SEEN} SELECT bot_name, day, user_id FROM first_seen WHERE day <> DATE '{r.ROLLBACK_DAY}'"
)
def job_publish(spark, sf_dir):
    """Published, corrected and published again; readers see the second version."""
    store, logs = _days(spark, sf_dir, "publish")
    out = f"{store.root}-published"
    jobs.publish(store, out)
    jobs.rollback_day(store, r.ROLLBACK_DAY)
    jobs.publish(store, out)
    return jobs.read_published(spark, out, "new_users_day")


# --- corrections --------------------------------------------------------------------------------


def _dim_bot(spark, sf_dir) -> DataFrame:
    return materialize(spark, testtables.dim_bots(_events(spark, sf_dir)), "dim_bot")


@query(f"WITH {r.DIM_BOT} SELECT bot_name FROM dim_bot WHERE type = '{r.BOT_TYPE}'")
def dim_bots_of_type(spark, sf_dir):
    return maintain.bots_of_type(_dim_bot(spark, sf_dir), r.BOT_TYPE)


def _rolled_back(spark, sf_dir, bots: DataFrame | None = None) -> KpiStore:
    """After a rollback, which the same backfill, run once more, does not undo."""
    store, logs = _days(spark, sf_dir, "rollback")
    jobs.rollback_day(store, r.ROLLBACK_DAY, bots)
    jobs.backfill_days(store, logs, "days")
    return store


@query(r.STRICT + f", {r.FIRST_SEEN} SELECT bot_name, user_id FROM first_seen WHERE day <> DATE '{r.ROLLBACK_DAY}'")
def rollback_day(spark, sf_dir):
    return _rolled_back(spark, sf_dir).users_total()


@query(
    r.STRICT + f", {r.FIRST_SEEN} SELECT bot_name, day, user_id FROM first_seen WHERE day <> DATE '{r.ROLLBACK_DAY}'"
)
def rollback_day_new_users(spark, sf_dir):
    return _rolled_back(spark, sf_dir).new_users_day()


@query(
    r.STRICT + f""", {r.FIRST_SEEN}, {r.DIM_BOT} SELECT bot_name, user_id FROM first_seen
    WHERE NOT (day = DATE '{r.ROLLBACK_DAY}' AND bot_name IN (SELECT bot_name FROM dim_bot WHERE type = '{r.BOT_TYPE}'))"""
)
def rollback_day_of_type(spark, sf_dir):
    return _rolled_back(spark, sf_dir, maintain.bots_of_type(_dim_bot(spark, sf_dir), r.BOT_TYPE)).users_total()


@query(r.STRICT + f"SELECT DISTINCT bot_name, user_id FROM strict WHERE bot_name NOT IN {r.PURGED}")
def purge_bots(spark, sf_dir):
    store, logs = _days(spark, sf_dir, "purge_bots")
    jobs.purge_bots(store, list(r.PURGED))
    jobs.backfill_days(store, logs, "days")
    return store.users_total()


@query(r.STRICT + f"SELECT bot_name, count(*) AS pv FROM strict WHERE bot_name NOT IN {r.PURGED} GROUP BY bot_name")
def purge_pv(spark, sf_dir):
    store, logs = _days(spark, sf_dir, "purge_pv")
    jobs.purge_pv(store, list(r.PURGED))
    jobs.backfill_days(store, logs, "days")
    return store.pv_total()
