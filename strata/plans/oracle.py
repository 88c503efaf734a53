"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code: entity views are CTEs over the driver
tables, aggregates are plain SQL. Agreement rules (both sides):
* money sums go through DECIMAL(20,4) and back to DOUBLE; means are that sum / count;
* standard deviations are rounded to 4 digits;
* integer results are cast to the Spark type (BIGINT counts, INTEGER day counts);
* every window has a total order.
"""

from __future__ import annotations

AS_OF = "DATE '2002-01-01'"


def msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(20,4))) AS DOUBLE)"


def mavg(x: str) -> str:
    return f"({msum(x)} / COUNT({x}))"


def flag(pred: str) -> str:
    return f"MAX(CASE WHEN {pred} THEN 1 ELSE 0 END)"


def cnt_where(pred: str) -> str:
    return f"CAST(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)"


_LINES = "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"

ENTITY_SQL: dict[str, str] = {
    "perimetre_raw": f"""
        SELECT c.c_custkey AS RADICAL,
               CAST(n.n_regionkey AS VARCHAR) AS BANQUE,
               CAST(c.c_nationkey AS VARCHAR) AS AGENCE,
               {AS_OF} - CAST(7000 + (c.c_custkey * 13) % 20000 AS INTEGER) AS DATE_OF_BIRTH,
               CAST(c.c_nationkey AS VARCHAR) AS CODE_VILLE,
               n.n_name AS LIBELLE_VILLE,
               r.r_name AS BPR,
               CASE c.c_custkey % 5 WHEN 0 THEN 'Masculin' WHEN 1 THEN 'Féminin'
                                    WHEN 2 THEN 'FÃ©minin' WHEN 3 THEN ' masculin ' END AS GENDER,
               c.c_mktsegment AS MARITAL_STATUS,
               CAST(c.c_custkey % 15 AS INTEGER) AS NOMBRE_ENFANT,
               CASE WHEN c.c_acctbal >= 5000 THEN 'A' WHEN c.c_acctbal >= 0 THEN 'B' ELSE 'C' END AS CUSTOMER_RATING,
               CASE c.c_custkey % 3 WHEN 0 THEN 'PME' WHEN 1 THEN 'GE' END AS TAILLE_ENTREPRI
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "perimetre": """
        SELECT * REPLACE (CASE WHEN trim(GENDER) = 'Masculin' THEN 'Masculin'
                               WHEN trim(GENDER) LIKE '%minin%' THEN 'Feminin' END AS GENDER)
        FROM perimetre_raw""",
    "assurance": f"""
        SELECT o.o_custkey AS RADICAL,
               CASE WHEN l.l_linestatus = 'O' THEN '11' ELSE '12' END AS ETATC,
               CASE WHEN p.p_size = 1 AND p.p_type = 'ECONOMY' THEN 'MaRetraite'
                    WHEN p.p_size = 1 AND p.p_type = 'MEDIUM' THEN 'AVENIR MESENFANTS'
                    WHEN p.p_size = 1 AND p.p_type = 'STANDARD' THEN 'EPARGNE EVOLUTION'
                    WHEN p.p_type = 'LARGE' THEN 'ATTAMINE CHAABI HISSAB'
                    WHEN p.p_type = 'PROMO' THEN 'INJAD ' || p.p_brand
                    ELSE 'PRODUIT ' || p.p_type END AS LIBELLE_PRODUIT,
               p.p_brand AS CODE_PRODUIT
        FROM {_LINES} JOIN part p ON l.l_partkey = p.p_partkey""",
    "comptes": "SELECT o_custkey AS RADICAL, o_orderkey AS CCLE, CAST(o_orderdate AS DATE) AS DTOUVR FROM orders",
    "soldes": "SELECT o_custkey AS RADICAL, o_totalprice AS SOLDEVERIF, CAST(o_orderdate AS DATE) AS DATE_CHARG FROM orders",
    "flux": """
        SELECT o_custkey AS RADICAL, o_totalprice AS FLUX_CRED,
               CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS DATE_CHARG
        FROM orders WHERE o_orderstatus = 'F'""",
    "gab": f"""SELECT o.o_custkey AS RADICAL, l.l_extendedprice AS MONTANT, CAST(l.l_shipdate AS DATE) AS DATE_OP
        FROM {_LINES} WHERE l.l_linenumber = 1""",
    "tpe": f"""SELECT o.o_custkey AS RADICAL, l.l_extendedprice AS MONTANT_TRANSACTION, CAST(l.l_shipdate AS DATE) AS DATE_ACHAT
        FROM {_LINES} WHERE l.l_linenumber = 2""",
    "retrait": f"""SELECT o.o_custkey AS RADICAL, l.l_orderkey AS NUM_CARTE, CAST(l.l_shipdate AS DATE) AS DATE_OP,
               l.l_extendedprice AS MONTANT
        FROM {_LINES} WHERE l.l_linenumber = 3""",
    "online_ope": f"""SELECT o.o_custkey AS RADICAL, l.l_extendedprice AS MONTANT, CAST(l.l_shipdate AS DATE) AS DATE_ACHAT
        FROM {_LINES} WHERE l.l_linenumber = 4""",
    "payfac": f"""SELECT o.o_custkey AS RADICAL, l.l_extendedprice AS MONTANT_TOTAL
        FROM {_LINES} WHERE l.l_linenumber = 5""",
    "depot": f"""SELECT o.o_custkey AS RADICAL, l.l_extendedprice AS MONTANT_DEPOT,
               CASE WHEN l.l_returnflag = 'A' THEN 'Dépôts à terme'
                    WHEN l.l_returnflag = 'N' THEN 'Dépôts à vue'
                    WHEN l.l_linestatus = 'O' THEN 'Bons de caisse'
                    ELSE 'Comptes sur carnets' END AS TYPE_DEPOT
        FROM {_LINES} WHERE l.l_linenumber = 6""",
    "mad": f"""SELECT o.o_custkey AS RADICAL, l.l_extendedprice AS MONTANT,
               CASE l.l_returnflag WHEN 'A' THEN 'MAD GAB' WHEN 'R' THEN 'MAD AGENCE' ELSE 'MAD DIVERS' END AS TYPE
        FROM {_LINES} WHERE l.l_linenumber = 7""",
    "virement": f"""SELECT o.o_custkey AS RADICAL,
               CASE l.l_returnflag WHEN 'A' THEN '1111' WHEN 'N' THEN '1112' ELSE '1113' END AS ETAT,
               l.l_extendedprice * (1 - l.l_discount) AS MT_OPE
        FROM {_LINES}""",
    "digital": """SELECT user_id AS RADICAL, event_type AS CLE,
               CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS DATE_RES_ABON
        FROM events""",
    "carte": """SELECT o_custkey AS RADICAL, o_orderkey AS NUMERO_CARTE,
               CAST(o_orderdate AS DATE) + 365 * CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS DT_FIN_VALID
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "opk": """SELECT o_custkey AS RADICAL, o_orderpriority AS CODE_PACK,
               CASE WHEN o_orderstatus = 'O' THEN 'V' ELSE o_orderstatus END AS ETATC
        FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')""",
    "vignette": """SELECT o_custkey AS RADICAL, CAST(year(o_orderdate) AS INTEGER) AS ANNEE_PAIEMENT,
               o_totalprice AS TOTAL_TTC
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "scored": """SELECT o_orderkey AS key,
               CASE WHEN ((o_orderkey * 7919) % 1009) / 1009.0 < (o_totalprice / 500000.0) * 0.5 THEN 1 ELSE 0 END AS y_true,
               o_totalprice / 500000.0 AS y_proba,
               (o_totalprice / 500000.0 + ((o_orderkey * 31) % 997) / 997.0) / 2 AS y_proba_b,
               ((o_orderkey * 61) % 1013) / 1013.0 AS y_proba_c
        FROM orders""",
}

# Features, one SQL aggregate per group (same names and order as the Spark groups).
FEATURE_SQL: dict[str, str] = {
    "labels": f"""SELECT RADICAL,
            {flag("LIBELLE_PRODUIT = 'MaRetraite'")} AS label_maRetraite,
            {flag("LIBELLE_PRODUIT = 'AVENIR MESENFANTS'")} AS label_avenirMesEnfants,
            {flag("LIBELLE_PRODUIT = 'EPARGNE EVOLUTION'")} AS label_epargneEvolution,
            {flag("LIBELLE_PRODUIT = 'ATTAMINE CHAABI HISSAB'")} AS has_attamine,
            {flag("LIBELLE_PRODUIT LIKE '%INJAD%'")} AS has_injad,
            COUNT(DISTINCT CODE_PRODUIT) AS nb_insurance_products
        FROM assurance WHERE ETATC = '11' GROUP BY RADICAL""",
    "comptes": f"""SELECT RADICAL, COUNT(DISTINCT CCLE) AS nb_accounts, MIN(DTOUVR) AS first_account_date,
            CAST(date_diff('day', MIN(DTOUVR), {AS_OF}) AS INTEGER) AS anciennete_days
        FROM comptes GROUP BY RADICAL""",
    "soldes": f"""SELECT s.RADICAL, {mavg("SOLDEVERIF")} AS avg_balance, MAX(SOLDEVERIF) AS max_balance,
            MIN(SOLDEVERIF) AS min_balance, ROUND(STDDEV_SAMP(SOLDEVERIF), 4) AS std_balance,
            COUNT(DATE_CHARG) AS nb_balance_snapshots, ANY_VALUE(lb.last_balance) AS last_balance
        FROM soldes s LEFT JOIN (
            SELECT RADICAL, SOLDEVERIF AS last_balance FROM (
                SELECT RADICAL, SOLDEVERIF, ROW_NUMBER() OVER (
                    PARTITION BY RADICAL ORDER BY DATE_CHARG DESC NULLS LAST, SOLDEVERIF DESC NULLS LAST) AS rn
                FROM soldes) WHERE rn = 1) lb ON s.RADICAL = lb.RADICAL
        GROUP BY s.RADICAL""",
    "flux": f"""SELECT RADICAL, {msum("FLUX_CRED")} AS total_flux_cred, {mavg("FLUX_CRED")} AS avg_flux_cred,
            MAX(FLUX_CRED) AS max_flux_cred, ROUND(STDDEV_SAMP(FLUX_CRED), 4) AS std_flux_cred,
            COUNT(DISTINCT DATE_CHARG) AS nb_flux_months
        FROM flux GROUP BY RADICAL""",
    "gab": f"""SELECT RADICAL, COUNT(*) AS nb_gab_transactions, {msum("MONTANT")} AS total_gab_amount,
            {mavg("MONTANT")} AS avg_gab_amount, MAX(MONTANT) AS max_gab_amount,
            COUNT(DISTINCT DATE_OP) AS nb_gab_active_days
        FROM gab GROUP BY RADICAL""",
    "tpe": f"""SELECT RADICAL, COUNT(*) AS nb_tpe_transactions, {msum("MONTANT_TRANSACTION")} AS total_tpe_amount,
            {mavg("MONTANT_TRANSACTION")} AS avg_tpe_amount, MAX(MONTANT_TRANSACTION) AS max_tpe_amount,
            COUNT(DISTINCT DATE_ACHAT) AS nb_tpe_active_days
        FROM tpe GROUP BY RADICAL""",
    "retrait": f"""SELECT RADICAL, COUNT(*) AS nb_retraits, {msum("MONTANT")} AS total_retrait_amount,
            {mavg("MONTANT")} AS avg_retrait_amount
        FROM retrait GROUP BY RADICAL""",
    "online": f"""SELECT RADICAL, COUNT(*) AS nb_online_transactions, {msum("MONTANT")} AS total_online_amount,
            {mavg("MONTANT")} AS avg_online_amount, COUNT(DISTINCT DATE_ACHAT) AS nb_online_active_days
        FROM online_ope GROUP BY RADICAL""",
    "digital": f"""SELECT RADICAL, 1 AS has_digital_product, {flag("DATE_RES_ABON IS NULL")} AS has_active_digital,
            COUNT(DISTINCT CLE) AS nb_digital_products
        FROM digital GROUP BY RADICAL""",
    "payfac": f"""SELECT RADICAL, COUNT(*) AS nb_payfac_transactions, {msum("MONTANT_TOTAL")} AS total_payfac_amount,
            {mavg("MONTANT_TOTAL")} AS avg_payfac_amount
        FROM payfac GROUP BY RADICAL""",
    "virement": f"""SELECT RADICAL, COUNT(*) AS nb_virements, {msum("MT_OPE")} AS total_virement_amount,
            {mavg("MT_OPE")} AS avg_virement_amount
        FROM virement WHERE ETAT IN ('1111', '1112') GROUP BY RADICAL""",
    "carte": f"""SELECT RADICAL, 1 AS has_carte, COUNT(DISTINCT NUMERO_CARTE) AS nb_cartes,
            {flag(f"DT_FIN_VALID >= {AS_OF}")} AS has_valid_carte
        FROM carte GROUP BY RADICAL""",
    "opk": f"""SELECT RADICAL, 1 AS has_pack, COUNT(DISTINCT CODE_PACK) AS nb_packs_ever,
            {flag("ETATC = 'V'")} AS has_active_pack
        FROM opk GROUP BY RADICAL""",
    "depot": f"""SELECT RADICAL, COUNT(*) AS nb_depots, {msum("MONTANT_DEPOT")} AS total_depot_amount,
            {mavg("MONTANT_DEPOT")} AS avg_depot_amount,
            {flag("TYPE_DEPOT = 'Dépôts à terme'")} AS has_depot_terme,
            {flag("TYPE_DEPOT = 'Dépôts à vue'")} AS has_depot_vue,
            {flag("TYPE_DEPOT = 'Bons de caisse'")} AS has_bon_caisse,
            {flag("TYPE_DEPOT = 'Comptes sur carnets'")} AS has_compte_carnet
        FROM depot GROUP BY RADICAL""",
    "mad": f"""SELECT RADICAL, COUNT(*) AS nb_mad_operations, {msum("MONTANT")} AS total_mad_amount,
            {mavg("MONTANT")} AS avg_mad_amount,
            {cnt_where("TYPE = 'MAD GAB'")} AS nb_mad_gab, {cnt_where("TYPE = 'MAD AGENCE'")} AS nb_mad_agence
        FROM mad GROUP BY RADICAL""",
    "vignette": f"""SELECT RADICAL, 1 AS has_vignette, COUNT(DISTINCT ANNEE_PAIEMENT) AS nb_vignette_years,
            {msum("TOTAL_TTC")} AS total_vignette_amount, MAX(ANNEE_PAIEMENT) AS last_vignette_year
        FROM vignette GROUP BY RADICAL""",
}

FEATURE_ENTITY = {
    "labels": "assurance", "comptes": "comptes", "soldes": "soldes", "flux": "flux", "gab": "gab", "tpe": "tpe",
    "retrait": "retrait", "online": "online_ope", "digital": "digital", "payfac": "payfac", "virement": "virement",
    "carte": "carte", "opk": "opk", "depot": "depot", "mad": "mad", "vignette": "vignette",
}

BASE_SQL = f"""SELECT RADICAL, BANQUE, AGENCE, CODE_VILLE, LIBELLE_VILLE, BPR, GENDER, MARITAL_STATUS,
        NOMBRE_ENFANT, CUSTOMER_RATING, TAILLE_ENTREPRI,
        CAST(floor(date_diff('day', DATE_OF_BIRTH, {AS_OF}) / 365) AS BIGINT) AS age
    FROM perimetre"""

# Column types of the joined master before the fill (to choose '0' or 0).
STRING_FILLED = ["BANQUE", "AGENCE", "CUSTOMER_RATING"]
NO_FILL = ["RADICAL", "GENDER", "MARITAL_STATUS", "CODE_VILLE", "LIBELLE_VILLE", "BPR", "TAILLE_ENTREPRI", "first_account_date"]


def with_ctes(body: str, names: list[str]) -> str:
    """Prefix ``body`` with the entity CTEs it needs (dependencies first)."""
    order = []
    for n in names:
        if n == "perimetre" and "perimetre_raw" not in order:
            order.append("perimetre_raw")
        if n not in order:
            order.append(n)
    ctes = ",\n".join(f"{n} AS ({ENTITY_SQL[n]})" for n in order)
    return f"WITH {ctes}\n{body}"


def feature_query(group: str) -> str:
    return with_ctes(FEATURE_SQL[group], [FEATURE_ENTITY[group]])


# Feature columns of the master table, in join order.
MASTER_FEATURE_COLUMNS = [
    "label_maRetraite", "label_avenirMesEnfants", "label_epargneEvolution", "has_attamine", "has_injad",
    "nb_insurance_products", "nb_accounts", "first_account_date", "anciennete_days",
    "avg_balance", "max_balance", "min_balance", "std_balance", "nb_balance_snapshots", "last_balance",
    "total_flux_cred", "avg_flux_cred", "max_flux_cred", "std_flux_cred", "nb_flux_months",
    "nb_gab_transactions", "total_gab_amount", "avg_gab_amount", "max_gab_amount", "nb_gab_active_days",
    "nb_tpe_transactions", "total_tpe_amount", "avg_tpe_amount", "max_tpe_amount", "nb_tpe_active_days",
    "nb_retraits", "total_retrait_amount", "avg_retrait_amount",
    "nb_online_transactions", "total_online_amount", "avg_online_amount", "nb_online_active_days",
    "has_digital_product", "has_active_digital", "nb_digital_products",
    "nb_payfac_transactions", "total_payfac_amount", "avg_payfac_amount",
    "nb_virements", "total_virement_amount", "avg_virement_amount",
    "has_carte", "nb_cartes", "has_valid_carte", "has_pack", "nb_packs_ever", "has_active_pack",
    "nb_depots", "total_depot_amount", "avg_depot_amount", "has_depot_terme", "has_depot_vue", "has_bon_caisse",
    "has_compte_carnet", "nb_mad_operations", "total_mad_amount", "avg_mad_amount", "nb_mad_gab", "nb_mad_agence",
    "has_vignette", "nb_vignette_years", "total_vignette_amount", "last_vignette_year",
]


def master_body(feature_columns: list[str]) -> str:
    """Base left-joined to every group, zero-filled, with the six derived columns."""
    groups = list(FEATURE_SQL)
    joins = "\n".join(f"LEFT JOIN g_{g} USING (RADICAL)" for g in groups)
    group_ctes = ",\n".join(f"g_{g} AS ({FEATURE_SQL[g]})" for g in groups)
    base_cols = ["RADICAL", "BANQUE", "AGENCE", "CODE_VILLE", "LIBELLE_VILLE", "BPR", "GENDER", "MARITAL_STATUS",
                 "NOMBRE_ENFANT", "CUSTOMER_RATING", "TAILLE_ENTREPRI", "age"]
    sel = []
    for c in base_cols + feature_columns:
        if c in NO_FILL:
            sel.append(c)
        elif c in STRING_FILLED:
            sel.append(f"COALESCE({c}, '0') AS {c}")
        else:
            sel.append(f"COALESCE({c}, 0) AS {c}")
    filled = ",\n    ".join(sel)

    def fl(c):
        return f"(CASE WHEN {c} > 0 THEN 1 ELSE 0 END)"

    derived = f"""avg_balance / (avg_flux_cred + 1) AS savings_ratio,
    has_digital_product + {fl("nb_payfac_transactions")} + {fl("nb_online_transactions")} AS digital_score,
    {fl("nb_gab_transactions")} + {fl("nb_tpe_transactions")} + {fl("nb_online_transactions")} + {fl("nb_virements")} AS spending_diversity,
    has_carte + has_pack + has_digital_product + has_vignette + has_attamine + has_injad + {fl("nb_depots")} AS product_breadth,
    last_balance - min_balance AS balance_trend,
    (total_gab_amount + total_tpe_amount + total_online_amount) / greatest(nb_flux_months, 1) AS avg_monthly_spend"""
    return f""", base AS ({BASE_SQL}),
{group_ctes},
joined AS (SELECT * FROM base {joins}),
filled AS (SELECT {filled} FROM joined)
SELECT *, {derived} FROM filled"""


ALL_ENTITIES = ["perimetre", "assurance", "comptes", "soldes", "flux", "gab", "tpe", "retrait", "online_ope",
                "digital", "payfac", "virement", "carte", "opk", "depot", "mad", "vignette"]


def master_cte_sql() -> str:
    """``WITH ...`` text defining every entity, the groups and ``filled`` / the final select."""
    head = with_ctes("", ALL_ENTITIES).rstrip()
    return head + master_body(MASTER_FEATURE_COLUMNS)


def over_master(select: str) -> str:
    """Wrap the master table as CTE ``master`` and run ``select`` on it."""
    head = with_ctes("", ALL_ENTITIES).rstrip()
    body = master_body(MASTER_FEATURE_COLUMNS)
    last = body.rindex("SELECT *, ")
    return head + body[:last] + ", master AS (" + body[last:] + ")\n" + select
