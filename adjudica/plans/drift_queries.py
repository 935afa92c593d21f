"""Catalogue: drift index, profile, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift, sketches
from ..operators.monitor import DAY, step_start
from ..session import work_dir
from .registry import query, table

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_DECILES = "[" + ", ".join(f"{i / 10}::DOUBLE" for i in range(11)) + "]"


def halves(spark, sf, name, ts, at):
    df = table(spark, sf, name)
    cut = F.to_timestamp_ntz(F.lit(at))
    return df.where(F.col(ts) < cut), df.where(F.col(ts) >= cut)


def _long(parts: list[tuple[str, str]], source: str, is_ref: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, {i} AS ordinal, {e} AS v, {is_ref} AS is_ref FROM {source}"
        for i, (f, e) in enumerate(parts)
    )


def numeric_psi_sql(parts: list[tuple[str, str]], source: str, is_ref: str) -> str:
    """CTE body: psi_num(feature, ordinal, psi)."""
    return f"""
    nlong AS ({_long(parts, source, is_ref)}),
    nedges AS (
      SELECT feature, list_sort(list_distinct(quantile_cont(v, {_DECILES}))) AS e
      FROM nlong WHERE is_ref AND v IS NOT NULL GROUP BY feature),
    nbin AS (
      SELECT feature, ordinal, is_ref, len(list_filter(e[2:-2], lambda x: v >= x)) AS b
      FROM nlong JOIN nedges USING (feature) WHERE v IS NOT NULL AND len(e) >= 3),
    ncnt AS (
      SELECT feature, ordinal, b, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
      FROM nbin GROUP BY ALL),
    nshare AS (
      SELECT feature, ordinal,
        greatest(r / sum(r) OVER (PARTITION BY feature), 1e-6) AS r,
        greatest(c / sum(c) OVER (PARTITION BY feature), 1e-6) AS c FROM ncnt),
    npsi AS (
      SELECT feature, ordinal, sum((c - r) * ln(c / r)) AS psi FROM nshare GROUP BY ALL),
    psi_num AS (
      SELECT f.feature, f.ordinal, coalesce(npsi.psi, 0.0) AS psi
      FROM (SELECT DISTINCT feature, ordinal FROM nlong) f LEFT JOIN npsi USING (feature))"""


def categorical_psi_sql(parts: list[tuple[str, str]], source: str, is_ref: str, base: int = 0) -> str:
    """CTE body: psi_cat(feature, ordinal, psi)."""
    return f"""
    clong AS ({_long(parts, source, is_ref)}),
    ccnt AS (
      SELECT feature, ordinal + {base} AS ordinal, coalesce(v, '__missing__') AS b,
        count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
      FROM clong GROUP BY ALL),
    cshare AS (
      SELECT feature, ordinal,
        greatest(r / sum(r) OVER (PARTITION BY feature), 1e-6) AS r,
        greatest(c / sum(c) OVER (PARTITION BY feature), 1e-6) AS c FROM ccnt),
    psi_cat AS (
      SELECT feature, ordinal, sum((c - r) * ln(c / r)) AS psi FROM cshare GROUP BY ALL)"""


_STATUS = "CASE WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.1 THEN 'warning' ELSE 'stable' END"
_SHIP = "l_shipdate < TIMESTAMP '1998-07-01'"


@query(
    "psi_numeric",
    f"""
    WITH {numeric_psi_sql([(c, c) for c in NUMERIC], 'lineitem', _SHIP)}
    SELECT feature, round(psi, 5) AS psi, {_STATUS} AS status FROM psi_num ORDER BY psi DESC, ordinal
    """,
)
def psi_numeric(spark, sf):
    before, after = halves(spark, sf, "lineitem", "l_shipdate", "1998-07-01")
    profile = drift.fit_profile(before, NUMERIC)
    return drift.ranked(drift.drift_table(profile, after)).select("feature", "psi", "status")


_SHIFT = "o_orderdate < TIMESTAMP '1998-04-01'"


@query(
    "psi_shifted",
    f"""
    WITH src AS (SELECT CASE WHEN {_SHIFT} THEN o_totalprice ELSE o_totalprice * 1.5 END AS price,
      CASE WHEN o_totalprice > 250000 THEN 1.0 ELSE 0.0 END AS large, o_orderdate FROM orders),
    {numeric_psi_sql([('price', 'price'), ('large', 'large')], 'src', _SHIFT)}
    SELECT feature, round(psi, 5) AS psi, {_STATUS} AS status FROM psi_num
    """,
)
def psi_shifted(spark, sf):
    """A scaled column alerts; a 0/1 column has too few deciles and stays at 0."""
    before, after = halves(spark, sf, "orders", "o_orderdate", "1998-04-01")
    large = F.when(F.col("o_totalprice") > 250000, 1.0).otherwise(0.0)

    def view(df, factor):
        return df.select((F.col("o_totalprice") * factor).alias("price"), large.alias("large"))

    profile = drift.fit_profile(view(before, 1.0), ["price", "large"])
    return drift.drift_table(profile, view(after, 1.5)).select("feature", "psi", "status")


_ORDER_CATS = [
    ("o_orderstatus", "o_orderstatus"),
    ("o_orderpriority", "o_orderpriority"),
    ("status_gaps", "nullif(o_orderstatus, 'P')"),
]


@query(
    "psi_categorical",
    f"""
    WITH {categorical_psi_sql(_ORDER_CATS, 'orders', _SHIFT)}
    SELECT feature, round(psi, 5) AS psi, {_STATUS} AS status FROM psi_cat ORDER BY psi DESC, ordinal
    """,
)
def psi_categorical(spark, sf):
    def view(df):
        return df.withColumn("status_gaps", F.nullif("o_orderstatus", F.lit("P")))

    before, after = halves(spark, sf, "orders", "o_orderdate", "1998-04-01")
    profile = drift.fit_profile(view(before), (), [f for f, _ in _ORDER_CATS])
    return drift.ranked(drift.drift_table(profile, view(after))).select("feature", "psi", "status")


@query(
    "drift_report",
    f"""
    WITH src AS (SELECT *, CASE WHEN {_SHIP} THEN l_quantity ELSE least(l_quantity + 8, 50) END AS qty,
      nullif(l_linestatus, 'O') AS gaps FROM lineitem),
    {numeric_psi_sql([('qty', 'qty'), ('l_tax', 'l_tax')], 'src', _SHIP)},
    {categorical_psi_sql([('l_returnflag', 'l_returnflag'), ('gaps', 'gaps')], 'src', _SHIP, 2)},
    both_ AS (SELECT * FROM psi_num UNION ALL SELECT * FROM psi_cat),
    rows_ AS (SELECT feature, ordinal, round(psi, 5) AS p, {_STATUS} AS status FROM both_)
    SELECT
      (SELECT count(*) FROM lineitem WHERE {_SHIP}) AS reference_rows,
      (SELECT count(*) FROM lineitem WHERE NOT ({_SHIP})) AS current_rows,
      string_agg(feature || ':' || status, ',' ORDER BY p DESC, ordinal) AS features,
      coalesce(string_agg(CASE WHEN status <> 'stable' THEN feature END, ',' ORDER BY ordinal), '') AS drifted_features,
      max(p) AS max_psi,
      CASE WHEN bool_or(status = 'alert') THEN 'alert' WHEN bool_or(status = 'warning') THEN 'warning'
        ELSE 'stable' END AS status
    FROM rows_
    """,
)
def drift_report(spark, sf):
    before, after = halves(spark, sf, "lineitem", "l_shipdate", "1998-07-01")

    def view(df, qty):
        return df.select(
            qty.alias("qty"), "l_tax", "l_returnflag", F.nullif("l_linestatus", F.lit("O")).alias("gaps")
        )

    report = drift.detect_drift(
        view(before, F.col("l_quantity")),
        view(after, F.least(F.col("l_quantity") + 8, F.lit(50.0))),
        ["qty", "l_tax"],
        ["l_returnflag", "gaps"],
    )
    return report.select(
        "reference_rows",
        "current_rows",
        F.array_join(
            F.transform("features", lambda e: F.concat(e.feature, F.lit(":"), e.status)), ","
        ).alias("features"),
        F.array_join("drifted_features", ",").alias("drifted_features"),
        "max_psi",
        "status",
    )


@query(
    "psi_profile_scoring",
    f"""
    WITH src AS (SELECT c_acctbal AS acctbal, c_nationkey::VARCHAR AS nation, true AS is_ref FROM customer
      UNION ALL SELECT s_acctbal, s_nationkey::VARCHAR, false FROM supplier),
    {numeric_psi_sql([('acctbal', 'acctbal')], 'src', 'is_ref')},
    {categorical_psi_sql([('nation', 'nation')], 'src', 'is_ref', 1)}
    SELECT feature, round(psi, 5) AS psi, {_STATUS} AS status
    FROM (SELECT * FROM psi_num UNION ALL SELECT * FROM psi_cat)
    """,
)
def psi_profile_scoring(spark, sf):
    """The reference is read once to store its profile; scoring reads the profile."""
    reference = table(spark, sf, "customer").select(
        F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nation")
    )
    path = work_dir(spark, "drift-profile")
    drift.fit_profile(reference, ["acctbal"], ["nation"]).save(path)
    current = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nation")
    )
    stored = drift.DriftProfile.load(spark, path)
    return drift.drift_table(stored, current).select("feature", "psi", "status")


def events_profile(spark, sf):
    """Profile of the first ten days of events."""
    events = table(spark, sf, "events")
    first = events.where(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-11")))
    return drift.fit_profile(first, ["value"], ["event_type"])


_BY_DAY = f"""
    WITH edges AS (
      SELECT list_sort(list_distinct(quantile_cont(value, {_DECILES}))) AS e
      FROM events WHERE ts < TIMESTAMP '2024-01-11'),
    tagged AS (
      SELECT ts, 'value' AS feature, len(list_filter(e[2:-2], lambda x: value >= x))::VARCHAR AS b
      FROM events, edges
      UNION ALL SELECT ts, 'event_type', event_type FROM events),
    ref AS (
      SELECT feature, b, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS r
      FROM tagged WHERE ts < TIMESTAMP '2024-01-11' GROUP BY feature, b),
    cur AS (
      SELECT (floor(epoch(ts))::BIGINT // 86400) * 86400 AS slot, feature, b, count(*) AS n
      FROM tagged GROUP BY ALL),
    sh AS (SELECT slot, feature, b, n / sum(n) OVER (PARTITION BY slot, feature) AS c FROM cur),
    full_ AS (
      SELECT w.slot, w.feature, x.b,
        greatest(coalesce(ref.r, 0), 1e-6) AS r, greatest(coalesce(sh.c, 0), 1e-6) AS c
      FROM (SELECT DISTINCT slot, feature FROM cur) w
      JOIN (SELECT feature, b FROM ref UNION SELECT feature, b FROM cur) x USING (feature)
      LEFT JOIN ref USING (feature, b)
      LEFT JOIN sh ON sh.slot = w.slot AND sh.feature = w.feature AND sh.b = x.b)
    SELECT slot, feature, round(sum((c - r) * ln(c / r)), 5) AS psi,
      CASE WHEN sum((c - r) * ln(c / r)) >= 0.25 THEN 'alert'
        WHEN sum((c - r) * ln(c / r)) >= 0.1 THEN 'warning' ELSE 'stable' END AS status
    FROM full_ GROUP BY slot, feature"""


@query("psi_by_day", _BY_DAY)
def psi_by_day(spark, sf):
    """Recurring check: every day of events against the stored profile."""
    profile = events_profile(spark, sf)
    events = table(spark, sf, "events")
    rows = drift.bucket_rows(
        events, profile.edges, profile.categorical, [step_start(events, "ts", DAY).alias("slot")]
    )
    counts = rows.groupBy("slot", "feature", "bucket").agg(F.count("*").alias("n"))
    scored = drift.psi_by_window(profile, counts, ["slot"])
    return scored.select(
        "slot", "feature", F.round("psi", 5).alias("psi"), drift.classify(F.col("psi")).alias("status")
    )




_FIRST_WEEK = "slot < (SELECT min(slot) FROM days) + 7 * 86400"
_DAYS = "days AS (SELECT *, (floor(epoch(ts))::BIGINT // 86400) * 86400 AS slot FROM events)"
#: The least value up to which a share of the rows lies; the sketch rounds places in the same way.
_DISCRETE = f"[l[greatest(1, ceil(round(p * len(l), 7)))::INTEGER] for p in {_DECILES}]"


def sketched_days(spark, sf):
    """Daily sketches of the events, stored as a table, with the first day and the end of the first week."""
    path = work_dir(spark, "daily-sketches")
    sketches.sketch_table(table(spark, sf, "events"), "ts", ["value", "user_id"]).write.parquet(path)
    stored_days = spark.read.schema(sketches.SCHEMA).parquet(path)
    first = stored_days.agg(F.min("slot")).first()[0]
    return stored_days, first, first + 6 * DAY


@query(
    "quantiles_of_days",
    f"""
    WITH {_DAYS},
    v AS (SELECT 'value' AS feature, value::DOUBLE AS v FROM days WHERE {_FIRST_WEEK} UNION ALL SELECT 'user_id', user_id FROM days WHERE {_FIRST_WEEK}),
    lists AS (SELECT feature, list(v ORDER BY v) AS l FROM v WHERE v IS NOT NULL GROUP BY feature)
    SELECT feature, len(l) AS rows, unnest({_DECILES}) AS prob, unnest({_DISCRETE}) AS value FROM lists
    """,
)
def quantiles_of_days(spark, sf):
    """Deciles of a week from the sketches of its days. Exact while the week has no more rows than the sketch keeps (K); on
    larger tables ranks are off by at most the sketch's error."""
    days, first, last = sketched_days(spark, sf)
    return sketches.quantiles(sketches.merged(days, first, last), [i / 10 for i in range(11)])


@query(
    "psi_sketched_days",
    f"""
    WITH {_DAYS}, {numeric_psi_sql([('value', 'value'), ('user_id', 'user_id::DOUBLE')], 'days', f'({_FIRST_WEEK})').replace(
        f"list_sort(list_distinct(quantile_cont(v, {_DECILES}))) AS e", f"list_sort(list_distinct({_DISCRETE})) AS e"
    ).replace("FROM nlong WHERE is_ref AND v IS NOT NULL GROUP BY feature)", "FROM (SELECT feature, list(v ORDER BY v) AS l FROM nlong WHERE is_ref AND v IS NOT NULL GROUP BY feature))")}
    SELECT feature, round(psi, 5) AS psi FROM psi_num
    """,
)
def psi_sketched_days(spark, sf):
    """All later events against a profile of the first week, which is read from its daily sketches alone."""
    days, first, last = sketched_days(spark, sf)
    profile = sketches.profile_of(days, ["value", "user_id"], first, last)
    events = table(spark, sf, "events")
    current = events.where(step_start(events, "ts", DAY) > last)
    return drift.psi_scores(profile, current).select("feature", F.round("psi", 5).alias("psi"))
