"""Entity views over the driver's TPC-H-like tables.

The bank sources (perimetre, comptes, soldes, ...) are not public, so each Silver
entity is a plain projection of the driver tables (customer, orders, lineitem,
part, events, nation, region). The same projections are written as SQL CTEs in
``plans.oracle`` so DuckDB can check every query built on top of them.

All views are lazy DataFrames; nothing is collected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import normalize_gender
from strata.session import table_path

# Fixed values of the fixture mapping (our own choice, stated once).
AS_OF = dt.date(2002, 1, 1)            # after the latest order and ship dates at every scale
AS_OF_SQL = "DATE '2002-01-01'"
# l_linenumber -> transaction entity
LINE_ENTITY = {"gab": 1, "tpe": 2, "retrait": 3, "online": 4, "payfac": 5, "depot": 6, "mad": 7}
CARD_PRIORITIES = ("1-URGENT", "2-HIGH")
PACK_PRIORITIES = ("3-MEDIUM", "4-NOT SPECIFIED")
VIGNETTE_PRIORITY = "5-LOW"


def as_of_col(as_of: dt.date | None = None) -> Column:
    return F.lit(as_of or AS_OF).cast("date")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _orders(spark, sf_dir):
    return read(spark, sf_dir, "orders")


def _order_lines(spark, sf_dir, line_number: int | None = None, lines: DataFrame | None = None):
    """lineitem joined to its order's customer (or ``lines``, which is that already); optionally one line number."""
    li = read(spark, sf_dir, "lineitem") if lines is None else lines
    if line_number is not None:
        li = li.filter(F.col("l_linenumber") == line_number)
    if lines is not None:
        return li
    o = _orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the entities made of order lines read, one join for all of them: to be stored and passed on as ``lines``."""
    return _order_lines(spark, sf_dir).select(
        "o_custkey", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag",
        "l_linestatus", "l_shipdate")


# ---------------------------------------------------------------- perimetre
def perimetre_raw(spark: SparkSession, sf_dir: str, as_of: dt.date | None = None) -> DataFrame:
    """Customer perimeter as it would arrive: gender in several encodings, padded text."""
    c = read(spark, sf_dir, "customer")
    # nation and region are fixed-size reference tables (25 and 5 rows): safe to broadcast
    n = F.broadcast(read(spark, sf_dir, "nation"))
    r = F.broadcast(read(spark, sf_dir, "region"))
    k = F.col("c_custkey")
    gender = (
        F.when(k % 5 == 0, F.lit("Masculin"))
        .when(k % 5 == 1, F.lit("Féminin"))
        .when(k % 5 == 2, F.lit("FÃ©minin"))
        .when(k % 5 == 3, F.lit(" masculin "))
    )
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "inner")
        .join(r, n.n_regionkey == r.r_regionkey, "inner")
        .select(
            k.alias("RADICAL"),
            F.col("n_regionkey").cast("string").alias("BANQUE"),
            F.col("c_nationkey").cast("string").alias("AGENCE"),
            F.date_sub(as_of_col(as_of), (7000 + (k * 13) % 20000).cast("int")).alias("DATE_OF_BIRTH"),
            F.col("c_nationkey").cast("string").alias("CODE_VILLE"),
            F.col("n_name").alias("LIBELLE_VILLE"),
            F.col("r_name").alias("BPR"),
            gender.alias("GENDER"),
            F.col("c_mktsegment").alias("MARITAL_STATUS"),
            (k % 15).cast("int").alias("NOMBRE_ENFANT"),
            F.when(F.col("c_acctbal") >= 5000, "A").when(F.col("c_acctbal") >= 0, "B").otherwise("C").alias("CUSTOMER_RATING"),
            F.when(k % 3 == 0, "PME").when(k % 3 == 1, "GE").alias("TAILLE_ENTREPRI"),
        )
    )


def perimetre(spark: SparkSession, sf_dir: str, as_of: dt.date | None = None) -> DataFrame:
    raw = perimetre_raw(spark, sf_dir, as_of)
    return normalize_gender(raw.withColumn("GENDER", F.trim("GENDER")))


# ---------------------------------------------------------------- products
def assurance(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = _order_lines(spark, sf_dir, lines=lines)
    p = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_brand")
    small = F.col("p_size") == 1
    t = F.col("p_type")
    product = (
        F.when(small & (t == "ECONOMY"), F.lit("MaRetraite"))
        .when(small & (t == "MEDIUM"), F.lit("AVENIR MESENFANTS"))
        .when(small & (t == "STANDARD"), F.lit("EPARGNE EVOLUTION"))
        .when(t == "LARGE", F.lit("ATTAMINE CHAABI HISSAB"))
        .when(t == "PROMO", F.concat(F.lit("INJAD "), F.col("p_brand")))
        .otherwise(F.concat(F.lit("PRODUIT "), t))
    )
    return lines.join(p, lines.l_partkey == p.p_partkey, "inner").select(
        F.col("o_custkey").alias("RADICAL"),
        F.when(F.col("l_linestatus") == "O", "11").otherwise("12").alias("ETATC"),
        product.alias("LIBELLE_PRODUIT"),
        F.col("p_brand").alias("CODE_PRODUIT"),
    )


# ---------------------------------------------------------------- accounts, balances, income
def comptes(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("o_orderkey").alias("CCLE"),
        F.col("o_orderdate").cast("date").alias("DTOUVR"),
    )


def soldes(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("o_totalprice").alias("SOLDEVERIF"),
        F.col("o_orderdate").cast("date").alias("DATE_CHARG"),
    )


def flux(spark, sf_dir):
    return (
        _orders(spark, sf_dir)
        .filter(F.col("o_orderstatus") == "F")
        .select(
            F.col("o_custkey").alias("RADICAL"),
            F.col("o_totalprice").alias("FLUX_CRED"),
            F.trunc(F.col("o_orderdate").cast("date"), "month").alias("DATE_CHARG"),
        )
    )


# ---------------------------------------------------------------- transactions (one line number each)
def _line_entity(spark, sf_dir, entity, lines):
    return _order_lines(spark, sf_dir, LINE_ENTITY[entity], lines)


def gab(spark, sf_dir, lines=None):
    return _line_entity(spark, sf_dir, "gab", lines).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("l_extendedprice").alias("MONTANT"),
        F.col("l_shipdate").cast("date").alias("DATE_OP"),
    )


def tpe(spark, sf_dir, lines=None):
    return _line_entity(spark, sf_dir, "tpe", lines).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("l_extendedprice").alias("MONTANT_TRANSACTION"),
        F.col("l_shipdate").cast("date").alias("DATE_ACHAT"),
    )


def retrait(spark, sf_dir, lines=None):
    return _line_entity(spark, sf_dir, "retrait", lines).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("l_orderkey").alias("NUM_CARTE"),
        F.col("l_shipdate").cast("date").alias("DATE_OP"),
        F.col("l_extendedprice").alias("MONTANT"),
    )


def online_ope(spark, sf_dir, lines=None):
    return _line_entity(spark, sf_dir, "online", lines).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("l_extendedprice").alias("MONTANT"),
        F.col("l_shipdate").cast("date").alias("DATE_ACHAT"),
    )


def payfac(spark, sf_dir, lines=None):
    return _line_entity(spark, sf_dir, "payfac", lines).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("l_extendedprice").alias("MONTANT_TOTAL"),
    )


def depot(spark, sf_dir, lines=None):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    kind = (
        F.when(flag == "A", F.lit("Dépôts à terme"))
        .when(flag == "N", F.lit("Dépôts à vue"))
        .when(status == "O", F.lit("Bons de caisse"))
        .otherwise(F.lit("Comptes sur carnets"))
    )
    return _line_entity(spark, sf_dir, "depot", lines).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("l_extendedprice").alias("MONTANT_DEPOT"),
        kind.alias("TYPE_DEPOT"),
    )


def mad(spark, sf_dir, lines=None):
    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "MAD GAB").when(flag == "R", "MAD AGENCE").otherwise("MAD DIVERS")
    return _line_entity(spark, sf_dir, "mad", lines).select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("l_extendedprice").alias("MONTANT"),
        kind.alias("TYPE"),
    )


def virement(spark, sf_dir, lines=None):
    flag = F.col("l_returnflag")
    state = F.when(flag == "A", "1111").when(flag == "N", "1112").otherwise("1113")
    return _order_lines(spark, sf_dir, lines=lines).select(
        F.col("o_custkey").alias("RADICAL"),
        state.alias("ETAT"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("MT_OPE"),
    )


# ---------------------------------------------------------------- holdings
def digital(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("RADICAL"),
        F.col("event_type").alias("CLE"),
        F.when(F.col("event_type") != "signup", F.col("ts").cast("date")).alias("DATE_RES_ABON"),
    )


def carte(spark, sf_dir):
    o = _orders(spark, sf_dir).filter(F.col("o_orderpriority").isin(*CARD_PRIORITIES))
    years = F.substring("o_orderpriority", 1, 1).cast("int")
    return o.select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("o_orderkey").alias("NUMERO_CARTE"),
        F.date_add(F.col("o_orderdate").cast("date"), years * 365).alias("DT_FIN_VALID"),
    )


def opk(spark, sf_dir):
    o = _orders(spark, sf_dir).filter(F.col("o_orderpriority").isin(*PACK_PRIORITIES))
    return o.select(
        F.col("o_custkey").alias("RADICAL"),
        F.col("o_orderpriority").alias("CODE_PACK"),
        F.when(F.col("o_orderstatus") == "O", "V").otherwise(F.col("o_orderstatus")).alias("ETATC"),
    )


def vignette(spark, sf_dir):
    o = _orders(spark, sf_dir).filter(F.col("o_orderpriority") == VIGNETTE_PRIORITY)
    return o.select(
        F.col("o_custkey").alias("RADICAL"),
        F.year("o_orderdate").alias("ANNEE_PAIEMENT"),
        F.col("o_totalprice").alias("TOTAL_TTC"),
    )


ENTITIES = {
    "perimetre": perimetre,
    "assurance": assurance,
    "comptes": comptes,
    "soldes": soldes,
    "flux": flux,
    "gab": gab,
    "tpe": tpe,
    "retrait": retrait,
    "online_ope": online_ope,
    "digital": digital,
    "payfac": payfac,
    "virement": virement,
    "carte": carte,
    "opk": opk,
    "depot": depot,
    "mad": mad,
    "vignette": vignette,
}


#: Entities made of order lines.
OF_LINES = ("assurance", "gab", "tpe", "retrait", "online_ope", "payfac", "virement", "depot", "mad")


def entity(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """An entity; ``lines``, the stored ``order_lines``, spares those of ``OF_LINES`` their join."""
    return ENTITIES[name](spark, sf_dir, lines) if name in OF_LINES else ENTITIES[name](spark, sf_dir)


# ---------------------------------------------------------------- scoring frame
def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An evaluation frame ``(key, y_true, y_proba, y_proba_b, y_proba_c)`` over orders.

    y_proba is the order value scaled to [0, 1]; the label is a deterministic
    pseudo-uniform of the key below half the score, so the score carries signal.
    Two more "models" give ensemble inputs.
    """
    o = _orders(spark, sf_dir)
    key = F.col("o_orderkey")
    score = F.col("o_totalprice") / F.lit(500000.0)
    uniform = ((key * 7919) % 1009) / F.lit(1009.0)
    return o.select(
        key.alias("key"),
        F.when(uniform < score * 0.5, 1).otherwise(0).alias("y_true"),
        score.alias("y_proba"),
        ((score + ((key * 31) % 997) / F.lit(997.0)) / 2).alias("y_proba_b"),
        (((key * 61) % 1013) / F.lit(1013.0)).alias("y_proba_c"),
    )
