"""Data-quality, source/sink and ingest queries."""

from __future__ import annotations

import itertools

import pandas as pd
from pyspark.sql import functions as F

from ..operators import quality as dq
from ..session import scratch_path
from ..sources import io
from ..sources import tables as tb
from .catalog import r6, register, s6
from .ingest import ingest, left_join_identity

# ---------------------------------------------------------------- schema rules


def _required_sql() -> str:
    def part(table, cols):
        lst = ", ".join(f"'{c}'" for c in cols)
        values = " UNION ALL ".join(f"SELECT '{c}' AS v, count({c}) AS n_values FROM {table}" for c in cols)
        return (f"SELECT '{table}' AS \"table\", c AS column_name, "
                f"c IN (SELECT column_name FROM (DESCRIBE SELECT * FROM {table})) AS present, n_values "
                f"FROM (SELECT unnest([{lst}]) AS c) JOIN ({values}) ON c = v")
    return tb.with_views(part("transactions", dq.TRANSACTION_REQUIRED) + "\nUNION ALL\n"
                         + part("identity", dq.IDENTITY_REQUIRED), "transactions", "identity")


@register("dq_required_columns", _required_sql())
def q_required(spark, sf):
    """Presence of each required column and how many values it holds."""
    t, i = tb.transactions(spark, sf), tb.identity(spark, sf)
    return (dq.required_columns_report(spark, t, dq.TRANSACTION_REQUIRED, "transactions")
            .unionByName(dq.required_columns_report(spark, i, dq.IDENTITY_REQUIRED, "identity")))


def _dtypes_sql() -> str:
    fam = ("CASE WHEN column_type IN ('BIGINT','INTEGER','SMALLINT','TINYINT') THEN 'int' "
           "WHEN column_type IN ('DOUBLE','FLOAT') THEN 'float' ELSE lower(column_type) END")
    exp = " UNION ALL ".join(f"SELECT '{c}' AS c, '{f}' AS f" for c, f in dq.EXPECTED_TYPES.items())
    parts = [f"""SELECT '{t}' AS "table", e.c AS column_name, e.f AS expected, {fam} AS actual, {fam} = e.f AS passed, v.n_values
FROM ({exp}) e JOIN (DESCRIBE SELECT * FROM {t}) d ON d.column_name = e.c
JOIN ({" UNION ALL ".join(f"SELECT '{c}' AS c, count({c}) AS n_values FROM {t}" for c in dq.EXPECTED_TYPES if c in held)}) v
  ON v.c = e.c""" for t, held in (("transactions", dq.EXPECTED_TYPES), ("identity", dq.IDENTITY_REQUIRED))]
    return tb.with_views("\nUNION ALL\n".join(parts), "transactions", "identity")


@register("dq_dtypes", _dtypes_sql())
def q_dtypes(spark, sf):
    """Type family of each typed column and how many values it holds."""
    out = None
    for df, name in ((tb.transactions(spark, sf), "transactions"), (tb.identity(spark, sf), "identity")):
        rows = spark.createDataFrame(dq.dtype_report(df, name), "table string, column_name string, expected string, "
                                                                "actual string, passed boolean")
        part = dq.with_value_counts(rows, df, [c for c in dq.EXPECTED_TYPES if c in df.columns])
        out = part if out is None else out.unionByName(part)
    return out


@register("dq_duplicate_keys", tb.with_views("""
SELECT 'txn.TransactionID' AS table_key, sum(c) AS n_rows, sum(c - 1) AS n_duplicates
FROM (SELECT count(*) AS c FROM txn GROUP BY TransactionID)
UNION ALL
SELECT 'lineitem.l_orderkey', sum(c), sum(c - 1) FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey)
UNION ALL
SELECT 'lineitem.l_orderkey,l_linenumber', sum(c), sum(c - 1)
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
""", "txn"))
def q_dup(spark, sf):
    li = tb.read_table(spark, sf, "lineitem")
    parts = [("txn.TransactionID", tb.txn(spark, sf), ["TransactionID"]),
             ("lineitem.l_orderkey", li, ["l_orderkey"]),
             ("lineitem.l_orderkey,l_linenumber", li, ["l_orderkey", "l_linenumber"])]
    out = None
    for name, df, keys in parts:
        d = dq.duplicate_key_count(df, keys).select(F.lit(name).alias("table_key"), "n_rows", "n_duplicates")
        out = d if out is None else out.unionByName(d)
    return out


# ---------------------------------------------------------------- label rules
# Order status as a label: F -> 1, O -> 0, P -> 2 (an out-of-domain value).
_ORD_LABEL = "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 WHEN 'P' THEN 2 END"


@register("dq_label_domain", f"""
SELECT cast(value AS int) AS value, count(*) AS n_rows
FROM (SELECT {_ORD_LABEL} AS value FROM orders)
WHERE value IS NOT NULL AND value NOT IN (0, 1) GROUP BY value
""")
def q_label_domain(spark, sf):
    o = tb.read_table(spark, sf, "orders").select(F.expr(_ORD_LABEL).cast("int").alias("isFraud"))
    return dq.label_domain_violations(o).select(F.col("value").cast("int").alias("value"), "n_rows")


@register("dq_label_rate", tb.with_views(f"""
SELECT 'txn' AS "table", {s6('avg(isFraud)')} AS label_rate,
       avg(isFraud) BETWEEN 0.01 AND 0.20 AS passed FROM txn
UNION ALL
SELECT 'orders', {s6('avg(l)')}, avg(l) BETWEEN 0.01 AND 0.20
FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS l FROM orders)
""", "txn"))
def q_label_rate(spark, sf):
    t = tb.txn(spark, sf).select("isFraud")
    o = tb.read_table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("isFraud"))
    out = None
    for name, df in (("txn", t), ("orders", o)):
        r = df.agg(F.avg("isFraud").alias("rate")).select(
            F.lit(name).alias("table"), r6("rate").alias("label_rate"),
            F.col("rate").between(dq.LABEL_RATE_MIN, dq.LABEL_RATE_MAX).alias("passed"))
        out = r if out is None else out.unionByName(r)
    return out


@register("dq_amount_range", tb.with_views("""
SELECT 'txn' AS "table", count(*) FILTER (WHERE TransactionAmt < 0) AS negative_amounts,
       count(*) FILTER (WHERE TransactionAmt > 20000) AS extreme_amounts FROM txn
UNION ALL
SELECT 'lineitem', count(*) FILTER (WHERE l_extendedprice - 5000 < 0),
       count(*) FILTER (WHERE l_extendedprice - 5000 > 20000) FROM lineitem
""", "txn"))
def q_amount_range(spark, sf):
    t = tb.txn(spark, sf).select("TransactionAmt", "isFraud")
    li = tb.read_table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") - 5000).alias("TransactionAmt"), F.lit(0).alias("isFraud"))
    out = None
    for name, df in (("txn", t), ("lineitem", li)):
        r = dq.row_rules(df).select(F.lit(name).alias("table"), "negative_amounts", "extreme_amounts")
        out = r if out is None else out.unionByName(r)
    return out


def _report_sql(table: str, view: str, required: list[str], with_rows: bool) -> str:
    lst = ", ".join(f"'{c}'" for c in required)
    desc = f"(DESCRIBE SELECT * FROM {view})"
    fam = ("CASE WHEN column_type IN ('BIGINT','INTEGER','SMALLINT','TINYINT') THEN 'int' "
           "WHEN column_type IN ('DOUBLE','FLOAT') THEN 'float' ELSE lower(column_type) END")
    exp = " UNION ALL ".join(f"SELECT '{c}' AS c, '{f}' AS f" for c, f in dq.EXPECTED_TYPES.items())
    parts = [
        f"""SELECT '{table}' AS "table", 'required_columns' AS rule, 'hard' AS severity,
       count(*) AS violations, count(*) = 0 AS passed, coalesce(string_agg(c, ',' ORDER BY pos), '') AS detail
FROM (SELECT c, generate_subscripts([{lst}], 1) AS pos FROM (SELECT unnest([{lst}]) AS c))
WHERE c NOT IN (SELECT column_name FROM {desc})""",
        f"""SELECT '{table}', 'dtype:' || e.c, 'soft', cast({fam} <> e.f AS bigint), {fam} = e.f,
       'expected ' || e.f || ', got ' || {fam}
FROM ({exp}) e JOIN {desc} d ON d.column_name = e.c""",
        f"""SELECT '{table}', 'duplicate_keys', 'hard', coalesce(sum(c - 1), 0), coalesce(sum(c - 1), 0) = 0, ''
FROM (SELECT count(*) AS c FROM {view} GROUP BY TransactionID)""",
    ]
    if with_rows:
        parts.append(f"""SELECT '{table}', r, s, v, v = 0, d FROM (
  SELECT unnest(['label_domain', 'label_rate', 'negative_amount', 'extreme_amount']) AS r,
         unnest(['hard', 'soft', 'soft', 'soft']) AS s,
         unnest([bad, CASE WHEN rate IS NULL OR rate < 0.01 OR rate > 0.2 THEN 1 ELSE 0 END, neg, ext]) AS v,
         unnest(['', cast(round(rate, 6) AS varchar), '', '']) AS d
  FROM (SELECT count(*) FILTER (WHERE isFraud IS NOT NULL AND isFraud NOT IN (0, 1)) AS bad,
               avg(isFraud) AS rate, count(*) FILTER (WHERE TransactionAmt < 0) AS neg,
               count(*) FILTER (WHERE TransactionAmt > 20000) AS ext FROM {view}))""")
    return "\nUNION ALL\n".join(parts)


@register("dq_report", tb.with_views(_report_sql("transactions", "transactions", dq.TRANSACTION_REQUIRED, True),
                                     "transactions"))
def q_report(spark, sf):
    return dq.transaction_report(spark, tb.transactions(spark, sf))


@register("dq_identity", tb.with_views(_report_sql("identity", "identity", dq.IDENTITY_REQUIRED, False),
                                       "identity"))
def q_identity(spark, sf):
    return dq.identity_report(spark, tb.identity(spark, sf))


# ---------------------------------------------------------------- profiling

def _null_rate_sql(top: int | None) -> str:
    aggs = ", ".join(f"avg(cast({c} IS NULL AS double)) AS {c}" for c in tb.TXN_COLUMNS)
    names = ", ".join(tb.TXN_COLUMNS)
    body = (f"SELECT column_name, {s6('null_rate')} AS null_rate, cast(null_rate > 0.5 AS int) AS above_half "
            f"FROM (SELECT {aggs} FROM txn) UNPIVOT (null_rate FOR column_name IN ({names}))")
    if top:
        body += f" ORDER BY null_rate DESC, column_name LIMIT {top}"
    return tb.with_views(body, "txn")


@register("null_rates", _null_rate_sql(20))
def q_null_rates(spark, sf):
    """Top 20 columns by null share (ties by name), flagged above 50 %."""
    r = dq.null_rates(tb.txn(spark, sf))
    return (r.orderBy(F.desc("null_rate"), "column_name").limit(20)
            .select("column_name", r6("null_rate").alias("null_rate"),
                    (F.col("null_rate") > 0.5).cast("int").alias("above_half")))


@register("null_rate_counts", tb.with_views(f"""
SELECT count(*) FILTER (WHERE null_rate > 0.5) AS n_over_50, count(*) FILTER (WHERE null_rate > 0.9) AS n_over_90,
       count(*) AS n_columns
FROM (SELECT {', '.join(f'avg(cast({c} IS NULL AS double)) AS {c}' for c in tb.TXN_COLUMNS)} FROM txn)
UNPIVOT (null_rate FOR column_name IN ({', '.join(tb.TXN_COLUMNS)}))
""", "txn"))
def q_null_rate_counts(spark, sf):
    r = dq.null_rates(tb.txn(spark, sf))
    return r.agg(F.count_if(F.col("null_rate") > 0.5).alias("n_over_50"),
                 F.count_if(F.col("null_rate") > 0.9).alias("n_over_90"),
                 F.count(F.lit(1)).alias("n_columns"))


@register("class_rate", tb.with_views(f"""
SELECT {s6('avg(isFraud)')} AS positive_rate, {s6('1 - avg(isFraud)')} AS negative_rate,
       count(isFraud) AS n_labelled FROM txn
""", "txn"))
def q_class_rate(spark, sf):
    r = dq.class_rate(tb.txn(spark, sf))
    return r.select(r6("positive_rate").alias("positive_rate"), r6("negative_rate").alias("negative_rate"),
                    "n_labelled")


# ------------------------------------------------------- request contract (S9, Q12)
# Requests derived from txn: the amount is sent as text; some are negative,
# some absent; card2 is sometimes unparsable text.
_K = "cast(V3 AS int)"
_AMT_TEXT = (f"CASE WHEN {_K} % 13 = 0 THEN NULL WHEN {_K} % 11 = 0 THEN cast(-TransactionAmt AS string) "
             f"ELSE cast(TransactionAmt AS string) END")
_CARD2_TEXT = f"CASE WHEN {_K} % 17 = 0 THEN 'n/a' ELSE cast(card2 AS string) END"


def _requests(spark, sf):
    t = tb.txn(spark, sf)
    fields = t.select("TransactionID", F.expr(_AMT_TEXT).alias("TransactionAmt"), "ProductCD", "card1",
                      F.expr(_CARD2_TEXT).alias("card2"), "card4", "P_emaildomain", "M1", "DeviceType")
    return io.request_json(fields)


@register("json_requests", tb.with_views("""
SELECT TransactionID,
       CASE WHEN cast(V3 AS int) % 13 = 0 THEN NULL WHEN cast(V3 AS int) % 11 = 0 THEN -TransactionAmt
            ELSE TransactionAmt END AS TransactionAmt,
       ProductCD, card1, CASE WHEN cast(V3 AS int) % 17 = 0 THEN NULL ELSE card2 END AS card2,
       card4, P_emaildomain, M1, DeviceType
FROM txn
""", "txn"))
def q_json_requests(spark, sf):
    p = io.parse_requests(_requests(spark, sf))
    return p.select("TransactionID", "TransactionAmt", "ProductCD", "card1", "card2", "card4",
                    "P_emaildomain", "M1", "DeviceType")


@register("validate_requests", tb.with_views("""
SELECT TransactionID, amt AS TransactionAmt,
       concat_ws(';', CASE WHEN amt IS NULL THEN 'TransactionAmt: field required' END,
                      CASE WHEN amt <= 0 THEN 'TransactionAmt must be positive' END,
                      CASE WHEN bad2 THEN 'card2: invalid value' END) AS reasons,
       cast(amt IS NOT NULL AND amt > 0 AND NOT bad2 AS int) AS accepted
FROM (SELECT TransactionID, cast(V3 AS int) % 17 = 0 AS bad2,
             CASE WHEN cast(V3 AS int) % 13 = 0 THEN NULL WHEN cast(V3 AS int) % 11 = 0 THEN -TransactionAmt
                  ELSE TransactionAmt END AS amt FROM txn)
""", "txn"))
def q_validate_requests(spark, sf):
    v = dq.validate_requests(io.parse_requests(_requests(spark, sf)))
    return v.select("TransactionID", "TransactionAmt", "reasons", "accepted")


# ------------------------------------------------------------- sources / sinks
_RT_COLS = ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "ProductCD", "card1",
            "card2", "P_emaildomain", "M1"]
_RT_SQL = tb.with_views(f"SELECT {', '.join(_RT_COLS)} FROM txn", "txn")


@register("csv_roundtrip", _RT_SQL)
def q_csv(spark, sf):
    path = scratch_path(spark, "csv")
    io.write_csv(tb.txn(spark, sf).select(*_RT_COLS), path)
    return io.read_csv(spark, path).select(*_RT_COLS)


_BAD_CSV = {"TransactionAmt": ("cast(V3 as int) % 13 = 0", "xx"), "isFraud": ("cast(V3 as int) % 17 = 0", "abc")}


def _csv_findings_sql() -> str:
    parts = []
    for c in _RT_COLS:
        if c in io.DECLARED_TYPES and io.DECLARED_TYPES[c].typeName() != "string":
            rule = _BAD_CSV.get(c, ("false", ""))[0]
            parts.append(f"SELECT '{c}' AS column_name, count(CASE WHEN {rule} THEN 1 WHEN {c} IS NOT NULL THEN 1 END) "
                         f"AS n_values, count(*) FILTER (WHERE {rule}) AS n_bad, "
                         f"count(*) FILTER (WHERE {rule}) = 0 AS passed FROM txn")
    return tb.with_views("\nUNION ALL\n".join(parts), "txn")


@register("csv_type_findings", _csv_findings_sql())
def q_csv_findings(spark, sf):
    """Texts in a CSV file that do not read as their declared type, counted per column."""
    path = scratch_path(spark, "csv_bad")
    t = tb.txn(spark, sf)
    cols = [F.when(F.expr(_BAD_CSV[c][0]), F.lit(_BAD_CSV[c][1])).otherwise(F.col(c).cast("string")).alias(c)
            if c in _BAD_CSV else F.col(c) for c in _RT_COLS]
    io.write_csv(t.select(*cols), path)
    return io.csv_type_findings(spark, path)


# Lines of a file with a quoted column that holds commas and quotes: by id some are cut short, some have a
# field more, some never close their quote.
_NOTE = "concat('a, ', chr(34), chr(34), ProductCD, chr(34), chr(34))"
_LINE = f"""CASE TransactionID % 10
  WHEN 1 THEN concat(TransactionID, ',', chr(34), {_NOTE}, chr(34))
  WHEN 2 THEN concat(TransactionID, ',', chr(34), {_NOTE}, chr(34), ',', isFraud, ',', ProductCD, ',x,y')
  WHEN 3 THEN concat(TransactionID, ',', chr(34), {_NOTE}, ',', isFraud, ',', ProductCD)
  ELSE concat(TransactionID, ',', chr(34), {_NOTE}, chr(34), ',', isFraud, ',', ProductCD) END"""


def _char(sql: str) -> str:
    return sql.replace("chr(34)", "char(34)")


@register("csv_quarantine", tb.with_views(f"""
SELECT {_LINE} AS line, CASE TransactionID % 10 WHEN 1 THEN 'too few fields: 2' WHEN 2 THEN 'too many fields: 6' WHEN 3 THEN 'unclosed quote' END AS reason,
       NULL::BIGINT AS TransactionID, NULL::INTEGER AS isFraud, NULL::VARCHAR AS note
FROM txn WHERE TransactionID % 10 IN (1, 2, 3)
UNION ALL SELECT NULL, NULL, TransactionID, isFraud, concat('a, "', ProductCD, '"') FROM txn WHERE TransactionID % 10 NOT IN (1, 2, 3)""", "txn"))
def q_csv_quarantine(spark, sf):
    """A CSV file with short, long and unclosed lines: typed rows on one side, quarantined lines with their
    reasons on the other."""
    path, out, bad = (scratch_path(spark, n) for n in ("csv_lines", "csv_rows", "csv_quarantine"))
    lines = tb.txn(spark, sf).selectExpr(f"{_char(_LINE)} AS value")
    parts = lines.repartition(3).sortWithinPartitions("value")
    header = "TransactionID,note,isFraud,ProductCD"
    # every file begins with the header
    parts.mapInPandas(lambda batches: itertools.chain([pd.DataFrame({"value": [header]})], batches), "value string").write.text(path)
    io.quarantine_csv(spark, path, out, bad)
    rows = spark.read.parquet(out).select(F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason"), "TransactionID", "isFraud", "note")
    held = spark.read.parquet(bad).select("line", "reason", F.lit(None).cast("bigint").alias("TransactionID"), F.lit(None).cast("int").alias("isFraud"),
                                          F.lit(None).cast("string").alias("note"))
    return rows.unionByName(held)


@register("parquet_roundtrip", _RT_SQL)
def q_parquet(spark, sf):
    path = scratch_path(spark, "parquet")
    io.write_parquet(tb.txn(spark, sf).select(*_RT_COLS), path)
    return spark.read.parquet(path).select(*_RT_COLS)


@register("partitioned_scan", tb.with_views("""
SELECT TransactionID, TransactionAmt, event_date FROM (
  SELECT TransactionID, TransactionAmt,
         strftime(DATE '2017-11-30' + cast(floor(TransactionDT / 86400) AS int), '%Y-%m-%d') AS event_date
  FROM txn)
WHERE event_date BETWEEN '2017-12-05' AND '2017-12-09'
""", "txn"))
def q_partitioned(spark, sf):
    """Date-partitioned layout; the date filter prunes partitions at planning time."""
    path = scratch_path(spark, "by_date")
    t = tb.txn(spark, sf).select(
        "TransactionID", "TransactionAmt",
        F.date_format(F.date_add(F.lit("2017-11-30").cast("date"),
                                 F.floor(F.col("TransactionDT") / 86400).cast("int")),
                      "yyyy-MM-dd").alias("event_date"))
    io.write_parquet(t, path, partition_by=["event_date"])
    back = spark.read.parquet(path)
    return (back.where(F.col("event_date").between("2017-12-05", "2017-12-09"))
            .select("TransactionID", "TransactionAmt", F.col("event_date").cast("string").alias("event_date")))


_MERGED_COLS = ["TransactionID", "isFraud", "TransactionAmt", "card1", "DeviceType", "DeviceInfo", "id_31"]
_MERGED_SQL = tb.with_views(f"""
SELECT {', '.join('t.' + c if c in ('TransactionID',) else c for c in _MERGED_COLS)}
FROM transactions t LEFT JOIN identity i ON t.TransactionID = i.TransactionID
""", "transactions", "identity")


@register("left_join_identity", _MERGED_SQL)
def q_left_join(spark, sf):
    return left_join_identity(tb.transactions(spark, sf), tb.identity(spark, sf)).select(*_MERGED_COLS)


@register("ingest_merged", _MERGED_SQL)
def q_ingest(spark, sf):
    res = ingest(spark, tb.transactions(spark, sf), tb.identity(spark, sf), scratch_path(spark, "ingest"))
    return spark.read.parquet(res.merged_path).select(*_MERGED_COLS)
