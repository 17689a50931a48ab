"""Entry points of the checker: a flagship query, all queries, and their SQL in DuckDB.

The raw, cleaned, rejected and mart tables are written once per session and data folder, in the
shared folder of the session, and read back by the queries: as in a daily run, no query derives
the raw table again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom import bindings as B
from cartloom.domains import STATES, STATUS_SYNONYMS
from cartloom.functions import safe_date, safe_int, safe_num, ws_trim
from cartloom.operators import adhoc, assertions, batch, canonical, checks, customers, reports, staging
from cartloom.operators.mart import build_fct_orders
from cartloom.operators.quarantine import reject_orders
from cartloom.operators.reconcile import reconcile
from cartloom.plans import daily, refresh
from cartloom.schemas import CLEANED_SCHEMA, RAW_COLUMNS, SOURCE_COLUMNS
from cartloom.session import freeing_shuffles, fresh_folder, tune
from cartloom.sources import landing, manifest, tables
from cartloom.streaming import arrivals
from cartloom.streaming.landing import stream_landing
from verification.oracle import oracle_statements

try:  # the training-data operators may have been left out
    import corpus_pipeline
    from cartloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "cartloom.llm"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

_written: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """Path of a table written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = fresh_folder(spark, name)
        with freeing_shuffles(spark):
            write(path)
        _written[key] = path
    return _written[key]


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    path = _stored(spark, sf_dir, "raw", lambda p: tables.append_raw(B.raw_orders(spark, sf_dir), p))
    return tables.read_raw(spark, path)


def loads_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_table(spark, sf_dir)
    return tables.read_loads(spark, _written[spark.sparkContext.applicationId, sf_dir, "raw"])


def _days(spark: SparkSession, sf_dir: str, day: B.dt.date) -> list[B.dt.date]:
    """Run dates loaded on a day: the only partitions of raw that a run of that day reads."""
    return batch.run_dates_of(loads_table(spark, sf_dir), day)


def cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        tables.overwrite_table(_cleaned(spark, sf_dir), path)

    return tables.read_cleaned(spark, _stored(spark, sf_dir, "cleaned", write))


def rejected_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        tables.overwrite_table(reject_orders(raw_table(spark, sf_dir), B.AS_OF, B.REJECTED_AT, _days(spark, sf_dir, B.AS_OF)), path)

    return tables.read_rejected(spark, _stored(spark, sf_dir, "rejected", write))


def mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        tables.write_mart(build_fct_orders(cleaned_table(spark, sf_dir), B.AS_OF), path)

    return tables.read_mart(spark, _stored(spark, sf_dir, "mart", write))


def _plain(df: DataFrame) -> DataFrame:
    """Dates and instants as text and decimals as doubles, so every engine shows them alike."""
    def show(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
        return c.alias(f.name)

    return df.select(*[show(f) for f in df.schema])


def _mapping(rows: DataFrame, name: str, canonical_of) -> DataFrame:
    """Raw text, canonical text and row count of a column."""
    text = F.col(name)
    return (
        rows.groupBy(text.alias("raw_value"))
        .agg(F.count("*").alias("row_count"))
        .select("raw_value", canonical_of(F.col("raw_value")).alias("canonical_value"), "row_count")
    )


def q_safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every different raw quantity, price and date with its parsed value."""
    raw = raw_table(spark, sf_dir)

    def kind(name: str, parsed) -> DataFrame:
        texts = raw.groupBy(F.col(name).alias("raw_value")).agg(F.count("*").alias("row_count"))
        return texts.select(F.lit(name).alias("column_name"), "raw_value", parsed(F.col("raw_value")).alias("parsed"), "row_count")

    return (
        kind("quantity", lambda c: safe_int(c).cast("string"))
        .union(kind("unit_price", lambda c: safe_num(c).cast("decimal(19,2)").cast("string")))
        .union(kind("order_date", lambda c: safe_date(c).cast("string")))
    )


def q_revenue_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batch.exact_distinct(batch.current_batch(raw_table(spark, sf_dir), B.AS_OF))
    texts = [F.col(c).alias(f"raw_{c}") for c in ("quantity", "unit_price", "discount_amount", "revenue")]
    corrected = staging.correct_revenue(rows.select(
        "order_id", "_source_filename", *texts, "quantity", "unit_price", "discount_amount", "revenue"
    ))
    return _plain(corrected)


def q_large_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue correction of amounts of up to 28 digits, shown as text so that every digit counts."""
    corrected = staging.correct_revenue(B.large_amounts(spark, sf_dir))
    return corrected.select(
        "l_orderkey", "l_linenumber", "quantity", F.col("unit_price").cast("string").alias("unit_price"),
        F.col("revenue").cast("string").alias("revenue"), "_revenue_was_corrected",
    )


def q_customer_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_table(spark, sf_dir).groupBy("customer_id", "customer_name", "customer_email", "customer_city", "customer_state")
    rows = raw.agg(F.count("*").alias("row_count"))
    cleaned = rows.select("row_count", *[c.alias(n) for n, c in staging.customer_columns().items()])
    return cleaned.groupBy(*staging.customer_columns()).agg(F.sum("row_count").alias("row_count"))


def q_typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batch.dedup_latest(batch.has_order_id(batch.current_batch(raw_table(spark, sf_dir), B.AS_OF)))
    return _plain(staging.type_orders(rows))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.clean_orders(raw_table(spark, sf_dir), B.AS_OF, run_dates=_days(spark, sf_dir, B.AS_OF))


def q_fct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The mart reads its orders twice, for two narrow counts: from the stored table, not by cleaning them twice.
    return _plain(build_fct_orders(cleaned_table(spark, sf_dir), B.AS_OF))


def q_customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by store and month, by store, and by category: exact, and whether the merged sketches are as near as stated."""
    orders = cleaned_table(spark, sf_dir)
    path = _stored(spark, sf_dir, "sketches", lambda p: customers.write_sketches(customers.customer_sketches(orders), p))
    sketches = spark.read.parquet(path)
    dated = orders.withColumns({"order_year": F.year("order_date").cast("int"), "order_month": F.month("order_date").cast("int")})

    def level(*keys: str) -> DataFrame:
        exact = dated.groupBy(*keys).agg(F.countDistinct("customer_id").alias("customers"))
        both = exact.join(customers.customers_over(sketches, *keys), list(keys), "full")
        near = F.abs(F.col("customers_estimate") - F.col("customers")) <= F.col("customers") * customers.stated_error()
        shown = [F.concat_ws("/", *keys).alias("of"), F.lit(" and ".join(keys)).alias("by")]
        return both.select(*shown, "customers", F.coalesce(near, F.lit(False)).alias("within_stated_error"))

    return level("store_name", "order_year", "order_month").union(level("store_name")).union(level("product_category"))


def _as_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_table(spark, sf_dir)
    return raw.where(F.col("_pipeline_run_date") == F.lit(B.AS_OF)).select(*SOURCE_COLUMNS)


def q_mart_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of the day before, refreshed twice on ``AS_OF``.

    The first refresh puts the batch's orders into a month of their own; the second brings them where
    they belong and empties that month on the same day.
    """
    raw, yesterday = raw_table(spark, sf_dir), B.AS_OF - B.dt.timedelta(days=1)
    folder = fresh_folder(spark, "refresh")
    with freeing_shuffles(spark):
        tables.replace_history_months(staging.clean_orders(raw, yesterday), f"{folder}/history")
        history = tables.read_history(spark, f"{folder}/history").select(*CLEANED_SCHEMA.names)
        tables.write_mart(build_fct_orders(history, yesterday), f"{folder}/mart")
    today = cleaned_table(spark, sf_dir)
    for batch in (today.withColumn("order_date", F.lit(B.dt.date(1950, 1, 1))), today):
        refresh.refresh(spark, f"{folder}/history", batch, f"{folder}/mart", B.AS_OF)
    return _plain(tables.read_mart(spark, f"{folder}/mart"))


def _write_exports(spark: SparkSession, sf_dir: str, folder: str, packed: bool = False) -> DataFrame:
    """The three loads of the raw table as CSV exports; returns their message list.

    ``packed`` exports take a quarter of the disk. A packed file is read by one task, so none has many rows.
    """
    raw = raw_table(spark, sf_dir)
    days = [B.AS_OF - B.dt.timedelta(days=n) for n in (0, 1, 2)]
    for day in days:
        rows = raw.where(F.col("_pipeline_run_date") == F.lit(day)).select(*SOURCE_COLUMNS)
        keep = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        if packed:
            keep |= {"compression": "gzip", "maxRecordsPerFile": 250_000}
        rows.write.options(**keep).csv(f"{folder}/{B.export_name(day)}")
    return spark.createDataFrame(
        [(B.export_name(d), d, B.utc_instant(d, 5)) for d in days], "filename string, run_date date, received_at timestamp"
    )


def q_landing_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV exports landed twice; the second time nothing is new."""
    folder = fresh_folder(spark, "landing")
    messages = _write_exports(spark, sf_dir, f"{folder}/inbox")
    for _ in range(2):
        landing.land_exports(spark, messages, f"{folder}/inbox", f"{folder}/raw", B.utc_instant(B.AS_OF, 6, 30))
    return _plain(tables.read_raw(spark, f"{folder}/raw"))


def q_landing_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export whose fields hold line breaks and quotes, cut into records by all tasks."""
    folder, name = fresh_folder(spark, "broken-lines"), B.export_name(B.AS_OF)
    rows = _as_of_file(spark, sf_dir).withColumn("customer_city", F.concat("customer_city", F.lit('\n"x", y\n\n')))
    keep = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**keep).csv(f"{folder}/{name}")
    message = spark.createDataFrame([(name, B.AS_OF, B.utc_instant(B.AS_OF, 5))], "filename string, run_date date, received_at timestamp")
    landing.land_exports(spark, message, folder, f"{folder}/raw", B.utc_instant(B.AS_OF, 6, 30))
    return _plain(tables.read_raw(spark, f"{folder}/raw"))


def q_stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same exports found by a file stream; run twice, the second run finds nothing new."""
    folder = fresh_folder(spark, "stream")
    _write_exports(spark, sf_dir, f"{folder}/inbox")
    for _ in range(2):
        stream_landing(
            spark, f"{folder}/inbox", f"{folder}/raw", f"{folder}/checkpoint", lambda: B.utc_instant(B.AS_OF, 6, 30)
        ).awaitTermination()
    return _plain(tables.read_raw(spark, f"{folder}/raw").drop("_email_received_date"))


def q_late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late, repeated and missing exports by sender; the stream is stopped half way, and run once more without news."""
    folder, messages = fresh_folder(spark, "arrivals"), B.repeated_messages(spark, sf_dir)
    half = F.col("received_at") < F.lit(B.utc_instant(B.dt.date(2024, 1, 15)))
    for part in (messages.where(half), messages.where(~half), None):
        if part is not None:
            part.write.mode("append").parquet(f"{folder}/inbox")
        arrivals.stream_arrivals(spark, f"{folder}/inbox", f"{folder}/arrivals", f"{folder}/checkpoint").awaitTermination()
    over = arrivals.read_arrivals(spark, f"{folder}/arrivals")
    missing = arrivals.missing_exports(over, B.dt.date(2024, 1, 1), B.dt.date(2024, 1, 25))
    name = F.concat(F.lit("e_com_sales_"), F.date_format("run_date", "yyyyMMdd"), F.lit(".csv")).alias("filename")
    gone = missing.select("sender", name, "run_date", F.lit("missing").alias("status"))
    return _plain(arrivals.lateness(over).unionByName(gone, allowMissingColumns=True))


def q_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole daily run on the export of ``AS_OF``; gives the mart it leaves behind.

    Plain exports would be more than half of all its files.
    """
    folder = fresh_folder(spark, "daily")
    exports = _write_exports(spark, sf_dir, f"{folder}/inbox", packed=True)
    messages = exports.select(
        F.unix_date("run_date").cast("bigint").alias("seq"),
        F.concat(F.lit("[E-Com] Daily Sales Export – "), F.date_format("run_date", "yyyy-MM-dd")).alias("subject"),
        F.lit("sales@shop.example").alias("sender"), "received_at", F.array("filename").alias("attachments"),
    )
    out = daily.Tables(f"{folder}/tables")
    outcome = daily.run_daily(spark, messages, f"{folder}/inbox", out, B.utc_instant(B.AS_OF, 6, 30))
    if outcome.status != "success":
        raise RuntimeError(outcome.message or outcome.status)
    return _plain(tables.read_mart(spark, out.at(spark).mart))


def q_dq_results_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results of two days in one table."""
    raw, path = raw_table(spark, sf_dir), fresh_folder(spark, "dq_results")
    for day in (B.AS_OF - B.dt.timedelta(days=1), B.AS_OF):
        for _ in range(2):  # a repeated run replaces its own results
            tables.keep_results(checks.dq_checks(raw, day, B.utc_instant(day, 6, 45), _days(spark, sf_dir, day)), path, day)
    return _plain(spark.read.parquet(path).drop("_run"))


def q_already_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a new delivery whose file the raw table of the first two loads does not have."""
    raw = raw_table(spark, sf_dir)
    before = raw.where(F.col("_pipeline_run_date") < F.lit(B.AS_OF))
    return _plain(landing.drop_already_loaded(raw, before).select(*RAW_COLUMNS))


def q_align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drifted frame (other order, one column more, one less) brought to the raw layout."""
    frame = raw_table(spark, sf_dir).select(*reversed(SOURCE_COLUMNS), F.lit("x").alias("coupon_code"))
    return landing.align_to_schema(frame.drop("payment_method"))


def q_drifted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of an export as parsed: a column the raw table does not have counts as well."""
    path = f"{fresh_folder(spark, 'drifted')}/{B.export_name(B.AS_OF)}"
    coupon = F.when(F.col("quantity") == "1", "SAVE").otherwise("").alias("coupon_code")
    rows = _as_of_file(spark, sf_dir).select("*", coupon).drop("payment_method")
    keep = {"header": True, "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**keep).csv(path)
    (frame,) = landing.read_landing_csv(spark, path)
    return reports.empty_cells_by_column(frame.drop("_source_filename"))


def q_landing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = B.landing_messages(spark, sf_dir)
    name = manifest.matching_attachment(F.col("attachments"))
    return _plain(messages.select(
        "seq", "subject", manifest.subject_day(F.col("subject")).alias("subject_date"),
        name.alias("filename"), manifest.filename_day(name).alias("filename_date"),
    ))


def q_read_only_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart_table(spark, sf_dir).createOrReplaceTempView("fct_orders")
    text = """
        SELECT product_category, order_year, SUM(total_units_sold) AS units
        FROM fct_orders WHERE shipping_status = :status GROUP BY product_category, order_year
    """
    return adhoc.read_only_sql(spark, text, {"status": "Shipped"})


def q_file_lookup_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_table(spark, sf_dir).createOrReplaceTempView("raw_orders")
    text = "SELECT _source_filename, COUNT(*) AS row_count FROM raw_orders WHERE _source_filename = :filename GROUP BY _source_filename"
    return adhoc.read_only_sql(spark, text, {"filename": B.export_name(B.AS_OF)})


def q_result_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = mart_table(spark, sf_dir).groupBy("order_date").agg(
        F.sum("total_revenue").alias("revenue"), (F.sum("total_units_sold") / F.lit(7.0)).alias("units_per_store")
    )
    return _plain(adhoc.preview(ranked.orderBy(F.col("revenue").desc(), "order_date")))


def q_cleaned_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = cleaned_table(spark, sf_dir)
    statuses = [name for name, _ in STATUS_SYNONYMS]
    return (
        assertions.assert_unique(orders, ["order_id"])
        .unionByName(assertions.assert_accepted_values(orders, "shipping_status", statuses))
        .unionByName(assertions.assert_accepted_values(orders, "customer_state", STATES))
        .unionByName(assertions.assert_not_null(orders, ["order_id", "order_date", "customer_name"]))
    )


def queries() -> dict[str, Query]:
    """All registered queries. Each runs over whole tables."""
    day = B.AS_OF
    return {
        "raw_orders": lambda s, d: _plain(raw_table(s, d)),
        "current_batch": lambda s, d: _plain(batch.current_batch(raw_table(s, d), day, _days(s, d, day))),
        "latest_run": lambda s, d: _plain(batch.latest_run(raw_table(s, d), loads_table(s, d))),
        "exact_distinct": lambda s, d: _plain(batch.exact_distinct(batch.current_batch(raw_table(s, d), day))),
        "dedup_latest": lambda s, d: _plain(batch.dedup_latest(batch.has_order_id(batch.current_batch(raw_table(s, d), day)))),
        "safe_casts": q_safe_casts,
        "customer_fields": q_customer_fields,
        "canonical_product": lambda s, d: _mapping(
            raw_table(s, d), "product_name", lambda c: canonical.canonical_product(c, canonical.product_key(c))),
        "canonical_category": lambda s, d: _mapping(
            raw_table(s, d), "product_category", lambda c: canonical.canonical_category(ws_trim(c))),
        "canonical_store": lambda s, d: _mapping(raw_table(s, d), "store_name", lambda c: canonical.canonical_store(ws_trim(c))),
        "canonical_status": lambda s, d: _mapping(
            raw_table(s, d), "shipping_status", lambda c: canonical.canonical_status(ws_trim(c))),
        "revenue_correction": q_revenue_correction,
        "large_amounts": q_large_amounts,
        "typed_orders": q_typed_orders,
        "orders_cleaned": lambda s, d: _plain(_cleaned(s, d)),
        "orders_rejected": lambda s, d: _plain(reject_orders(raw_table(s, d), day, B.REJECTED_AT, _days(s, d, day))),
        "fct_orders": q_fct_orders,
        "mart_assertions": lambda s, d: assertions.mart_assertions(mart_table(s, d)),
        "cleaned_assertions": q_cleaned_assertions,
        "dq_checks": lambda s, d: _plain(checks.dq_checks(raw_table(s, d), day, B.CHECKED_AT, _days(s, d, day))),
        "dq_critical": lambda s, d: _plain(
            checks.critical_failures(checks.dq_checks(raw_table(s, d), day, B.CHECKED_AT, _days(s, d, day)))),
        "dq_empty_batch": lambda s, d: _plain(
            checks.dq_checks(raw_table(s, d), day + B.dt.timedelta(days=30), B.CHECKED_AT)),
        "dq_results_log": q_dq_results_log,
        "stage_funnel": lambda s, d: _plain(
            reports.stage_funnel(raw_table(s, d), cleaned_table(s, d), rejected_table(s, d), loads_table(s, d))),
        "stage_reconcile": lambda s, d: reconcile(
            raw_table(s, d), cleaned_table(s, d), rejected_table(s, d), day, _days(s, d, day)),
        "rejection_reasons": lambda s, d: reports.rejection_reasons(rejected_table(s, d), day),
        "load_quality_report": lambda s, d: reports.load_quality_report(_as_of_file(s, d)),
        "drifted_load_quality": q_drifted_quality,
        "empty_cells_by_column": lambda s, d: reports.empty_cells_by_column(_as_of_file(s, d)),
        "landing_select_latest": lambda s, d: _plain(
            manifest.select_latest_landing(B.landing_messages(s, d), B.MANIFEST_NOW)),
        "landing_recent_matches": lambda s, d: manifest.recent_matches(B.landing_messages(s, d)).select("seq", "subject"),
        "landing_dates": q_landing_dates,
        "landing_already_loaded": q_already_loaded,
        "landing_exports": q_landing_exports,
        "landing_broken_lines": q_landing_broken_lines,
        "stream_landing": q_stream_landing,
        "late_arrivals": q_late_arrivals,
        "align_schema": q_align_schema,
        "mart_stored": lambda s, d: _plain(mart_table(s, d)),
        "customer_totals": q_customer_totals,
        "mart_upsert": q_mart_upsert,
        "daily_run": q_daily_run,
        "starter_last_month": lambda s, d: _plain(adhoc.last_month_performance(mart_table(s, d), day)),
        "starter_top_product": lambda s, d: _plain(adhoc.best_selling_products(mart_table(s, d))),
        "starter_best_store": lambda s, d: _plain(adhoc.best_stores(mart_table(s, d))),
        "starter_store_revenue_year": lambda s, d: _plain(adhoc.store_revenue_this_year(mart_table(s, d), day)),
        "monthly_revenue": lambda s, d: _plain(adhoc.monthly_revenue(mart_table(s, d))),
        "read_only_sql": q_read_only_sql,
        "file_lookup_sql": q_file_lookup_sql,
        "result_preview": q_result_preview,
        **({**llm_queries.QUERIES, "pipeline": corpus_pipeline.run} if llm_queries else {}),
    }


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the given tables."""
    return {**oracle_statements(), **(llm_queries.ORACLE_SQL if llm_queries else {})}


def entry(spark: SparkSession) -> DataFrame:
    """The daily fact table of the smallest data set."""
    return q_fct_orders(spark, "/root/testdata/sf0.001")
