"""DuckDB oracle SQL for the Silver (cleaning) queries."""

from __future__ import annotations

from strata.plans.oracle import AS_OF, with_ctes

ACCOUNTS_RAW = """accounts_raw AS (
  SELECT CASE WHEN o_orderkey % 53 = 0 THEN NULL
              WHEN o_orderkey % 7 = 0 THEN '  ' || CAST(o_custkey AS VARCHAR) || ' '
              ELSE CAST(o_custkey AS VARCHAR) END AS CONTRAT,
         CAST(o_orderkey AS VARCHAR) AS CCLE,
         CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
              WHEN o_orderkey % 89 = 0 THEN NULL
              WHEN o_orderkey % 13 = 0 THEN '1899-12-31'
              WHEN o_orderkey % 17 = 0 THEN '2030-01-01'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DTOUVR,
         CASE WHEN o_orderkey % 101 = 0 THEN 'x'
              WHEN o_orderkey % 103 = 0 THEN ''
              WHEN o_orderkey % 11 = 0 THEN '-' || CAST(o_totalprice AS VARCHAR)
              ELSE CAST(o_totalprice AS VARCHAR) END AS SOLDE,
         CASE WHEN o_orderkey % 19 = 0 THEN '3.7' ELSE CAST(o_orderkey % 9 AS VARCHAR) END AS NB,
         CASE WHEN o_orderkey % 5 = 0 THEN ' ' || lower(o_orderstatus) || ' ' ELSE lower(o_orderstatus) END AS STATUS
  FROM orders)"""

TYPED = f"""{ACCOUNTS_RAW},
typed AS (
  SELECT CAST(trunc(TRY_CAST(trim(CONTRAT) AS DECIMAL(38,10))) AS BIGINT) AS RADICAL,
         CAST(trunc(TRY_CAST(trim(CCLE) AS DECIMAL(38,10))) AS BIGINT) AS CCLE,
         TRY_CAST(try_strptime(trim(DTOUVR), '%Y-%m-%d') AS DATE) AS DTOUVR,
         TRY_CAST(trim(SOLDE) AS DOUBLE) AS SOLDE,
         CAST(trunc(TRY_CAST(trim(NB) AS DECIMAL(38,10))) AS INTEGER) AS NB,
         upper(trim(STATUS)) AS STATUS
  FROM accounts_raw)"""

DATE_OK = f"(DTOUVR IS NULL OR (DTOUVR >= DATE '1996-01-01' AND DTOUVR <= {AS_OF}))"
AMOUNT_OK = "(SOLDE IS NULL OR SOLDE >= 0)"
KEY_OK = "RADICAL IS NOT NULL"

PARTIES = """parties AS (
  SELECT c_custkey AS CONTRAT, c_name AS NOM, c_acctbal AS SOLDE, c_mktsegment AS SEGMENT FROM customer
  UNION ALL BY NAME
  SELECT s_suppkey AS ID_FOURN, s_name AS NOM, s_acctbal AS SOLDE, s_nationkey AS NATION FROM supplier)"""

_LINE_OTHERS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                "l_linestatus", "l_shipdate"]

ORACLE = {
    "clean_cast": f"WITH {TYPED} SELECT * FROM typed",
    "clean_date_range": f"WITH {TYPED} SELECT * FROM typed WHERE {DATE_OK}",
    "clean_non_negative": f"WITH {TYPED} SELECT * FROM typed WHERE {AMOUNT_OK}",
    "clean_not_null": f"WITH {TYPED} SELECT * FROM typed WHERE {KEY_OK}",
    "clean_full": f"""WITH {TYPED},
        kept AS (SELECT * FROM typed WHERE {DATE_OK} AND {AMOUNT_OK} AND {KEY_OK}),
        ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY RADICAL, DTOUVR
                     ORDER BY CCLE ASC NULLS FIRST, SOLDE ASC NULLS FIRST, NB ASC NULLS FIRST,
                              STATUS ASC NULLS FIRST) AS rn FROM kept)
        SELECT RADICAL, CCLE, DTOUVR, SOLDE, NB, STATUS FROM ranked WHERE rn = 1""",
    "union_sources": f"WITH {PARTIES} SELECT * FROM parties",
    "rename_merge": f"WITH {PARTIES} SELECT COALESCE(CONTRAT, ID_FOURN) AS RADICAL, NOM, SOLDE, SEGMENT, NATION FROM parties",
    "clean_parties": f"""WITH {PARTIES}
        SELECT * FROM (SELECT COALESCE(CONTRAT, ID_FOURN) AS RADICAL, trim(NOM) AS NOM, SOLDE, trim(SEGMENT) AS SEGMENT,
                              NATION FROM parties) WHERE RADICAL IS NOT NULL""",
    "dedup_keys": f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in _LINE_OTHERS)}) AS rn FROM lineitem)
        WHERE rn = 1""",
    "normalize_gender": with_ctes(
        """SELECT RADICAL, GENDER AS GENDER_RAW,
                  CASE WHEN trim(GENDER) = 'Masculin' THEN 'Masculin'
                       WHEN trim(GENDER) LIKE '%minin%' THEN 'Feminin' END AS GENDER
           FROM perimetre_raw""", ["perimetre_raw"]),
}

ORACLE_LAKE = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_multi": "SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier",
    "scan_tolerant": "SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier",
    "write_overwrite": ORACLE["clean_full"],
    "register_table": ORACLE["clean_full"],
    "gate_rows": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", COUNT(*) AS n_rows,
               CAST(SUM(CASE WHEN {" OR ".join(k + " IS NULL" for k in keys)} THEN 1 ELSE 0 END) AS BIGINT) AS null_keys,
               COUNT(*) - CAST(SUM(CASE WHEN {" OR ".join(k + " IS NULL" for k in keys)} THEN 1 ELSE 0 END) AS BIGINT)
                 - COUNT(DISTINCT ({", ".join(keys)})) AS duplicate_keys,
               COUNT(*) >= 1 AND SUM(CASE WHEN {" OR ".join(k + " IS NULL" for k in keys)} THEN 1 ELSE 0 END) = 0
                 AND COUNT(*) - COUNT(DISTINCT ({", ".join(keys)})) = 0 AS passed
            FROM {t}"""
        for t, keys in {"customer": ["c_custkey"], "orders": ["o_orderkey"],
                        "lineitem": ["l_orderkey", "l_linenumber"], "part": ["p_partkey"]}.items()),
}

# one file a table, so a threshold of two files fails; an absent table is a failed row
GATE_PATHS = """
    SELECT 'orders' AS "table", COUNT(*) AS n_rows, CAST(1 AS BIGINT) AS n_files, COUNT(*) >= 1 AS passed FROM orders
    UNION ALL SELECT 'customer', COUNT(*), CAST(1 AS BIGINT), FALSE FROM customer
    UNION ALL SELECT 'no_such_table', CAST(0 AS BIGINT), CAST(0 AS BIGINT), FALSE"""
