"""Readers for the driver's Parquet tables and the fraud-shaped views over them.

The test tables are generic (events, orders, documents, labels, ...).  The
views below give them the column names and null patterns of card
transactions so every operator of the library runs over whole tables whose
size grows with the scale factor.  Each view is written once as SQL
expressions and used by both engines: Spark reads the Parquet files and
projects with ``selectExpr`` (pruning and pushdown stay intact); the DuckDB
oracle gets the same text as a CTE.  Only two expressions differ by dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- txn: one transaction per event -----------------------------------------
# k is the small integer inside `props`; every derived category is a pure
# function of k, user_id or event_id, so both engines agree row by row.
_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"


def _txn_exprs(dialect: str) -> list[str]:
    if dialect == "spark":
        dt = "timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', ts)"
    else:
        dt = "epoch_us(ts) // 1000000 - 1704067200"
    return [
        "event_id AS TransactionID",
        f"cast({dt} as bigint) AS TransactionDT",
        "value AS TransactionAmt",
        "cast(event_type = 'error' as int) AS isFraud",
        "user_id AS card1",
        "substr('CHRSW', k % 5 + 1, 1) AS ProductCD",
        "cast(100 + (k * 37) % 500 as double) AS card2",
        "cast(100 + k % 100 as double) AS card3",
        "case k % 5 when 0 then 'Visa ' when 1 then ' mastercard' when 2 then 'discover' "
        "when 3 then 'jcb' end AS card4",
        "cast(100 + (k * 13) % 150 as double) AS card5",
        "case k % 4 when 0 then 'credit' when 1 then 'debit' when 2 then 'Debit or Credit' end AS card6",
        "cast(100 + (user_id * 7) % 400 as double) AS addr1",
        "case when k % 9 <> 0 then cast(1 + k % 99 as double) end AS addr2",
        "case when k % 2 = 0 then value * 3 end AS dist1",
        "case when k % 13 = 0 then value end AS dist2",
        "case when k % 7 <> 0 then concat('d', cast(k % 10 as string), '.com') end AS P_emaildomain",
        "case when k % 5 = 1 then concat('r', cast(k % 3 as string), '.com') end AS R_emaildomain",
        "cast(k % 40 as double) AS C1",
        "cast(k % 17 as double) AS C2",
        "cast(0 as double) AS C3",
        "cast(user_id % 30 as double) AS C4",
        "case k % 3 when 0 then 'T' when 1 then 'F' end AS M1",
        "case k % 4 when 0 then 'T' when 1 then 'F' end AS M2",
        "case when k % 6 < 3 then 'T' else 'F' end AS M3",
        "case k % 4 when 0 then 'M0' when 1 then 'm1' when 2 then 'M2' end AS M4",
        "case k % 3 when 0 then 'desktop' when 1 then 'Mobile' end AS DeviceType",
        "value AS V1",
        "2 * value + 1 AS V2",
        "cast(k as double) AS V3",
        "k + value AS V4",
        "case when k % 4 <> 0 then value end AS V5",
        "cast(7 as double) AS V6",
        "cast((event_id * 7919 + k * 31) % 1000 as double) / 1000.0 AS p",
    ]


TXN_COLUMNS = [e.rsplit(" AS ", 1)[1] for e in _txn_exprs("spark")]
V_COLUMNS = ["V1", "V2", "V3", "V4", "V5", "V6"]

_IDENTITY_EXPRS = [
    "doc_id AS TransactionID",
    "case when quality = 1 then 'mobile' else 'desktop' end AS DeviceType",
    "case when toxic = 1 then 'iOS Device' when doc_id % 5 = 0 then NULL else 'Windows' end AS DeviceInfo",
    "case doc_id % 4 when 0 then 'chrome' when 1 then 'safari' when 2 then 'edge' end AS id_31",
]


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture transactions over the whole ``events`` table."""
    ev = read_table(spark, sf_dir, "events").selectExpr("*", f"{_K} AS k")
    return ev.selectExpr(*_txn_exprs("spark"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction table of the ingest job: identity columns live elsewhere."""
    return txn(spark, sf_dir).drop("DeviceType")


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse side table: one row for each labelled document id."""
    return read_table(spark, sf_dir, "labels").selectExpr(*_IDENTITY_EXPRS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score + label table for the evaluation operators (score ``p`` has ties)."""
    return txn(spark, sf_dir).select("TransactionID", "TransactionDT", "isFraud", "p")


# --- DuckDB text of the same views -------------------------------------------

def duck_view(name: str) -> str:
    if name == "txn":
        return (f"SELECT {', '.join(_txn_exprs('duckdb'))} "
                f"FROM (SELECT *, {_K} AS k FROM events) e")
    if name == "transactions":
        return "SELECT * EXCLUDE (DeviceType) FROM txn"
    if name == "identity":
        return f"SELECT {', '.join(_IDENTITY_EXPRS)} FROM labels"
    if name == "scored":
        return "SELECT TransactionID, TransactionDT, isFraud, p FROM txn"
    raise KeyError(name)


_DEPENDS = {"transactions": ["txn"], "scored": ["txn"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named fixture views (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({duck_view(n)})" for n in order)
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        return f"WITH {ctes},\n{sql[5:]}"
    return f"WITH {ctes}\n{sql}"
