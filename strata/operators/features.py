"""Feature groups: one ``groupBy(RADICAL).agg(...)`` per Silver entity.

Each group is a pure function ``entity DataFrame -> one row per customer``.
All aggregates are algebraic (partial aggregation before the shuffle), so a
customer holding a large share of the rows costs one partial row per map task,
not one hot reduce task. The one "latest value" feature uses ``max_by`` inside
the same aggregate instead of a window + self-join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.aggs import any_flag, count_where, money_avg, money_sum, present, std_samp

KEY = "RADICAL"

# Product names, state codes and type labels the features test for.
ACTIVE_POLICY_STATE = "11"
TARGET_PRODUCTS = {
    "label_maRetraite": "MaRetraite",
    "label_avenirMesEnfants": "AVENIR MESENFANTS",
    "label_epargneEvolution": "EPARGNE EVOLUTION",
}
ATTAMINE_PRODUCT = "ATTAMINE CHAABI HISSAB"
INJAD_MARKER = "INJAD"
TRANSFER_STATES = ("1111", "1112")
ACTIVE_PACK_STATE = "V"
DEPOSIT_TYPES = {
    "has_depot_terme": "Dépôts à terme",
    "has_depot_vue": "Dépôts à vue",
    "has_bon_caisse": "Bons de caisse",
    "has_compte_carnet": "Comptes sur carnets",
}
MAD_TYPES = {"nb_mad_gab": "MAD GAB", "nb_mad_agence": "MAD AGENCE"}

LABELS = list(TARGET_PRODUCTS)


def _as_of(as_of: dt.date | Column | None) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date") if as_of is not None else F.current_date()


@dataclass(frozen=True)
class FeatureGroup:
    """A named ``groupBy(KEY).agg`` over one entity, with an optional row filter."""

    name: str
    entity: str
    aggs: Callable[[Column], list[Column]]
    where: Callable[[], Column] | None = None

    def build(self, df: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
        if self.where is not None:
            df = df.filter(self.where())
        return df.groupBy(KEY).agg(*self.aggs(_as_of(as_of)))


def _labels(_):
    lib = F.col("LIBELLE_PRODUIT")
    return [
        *(any_flag(lib == name).alias(col) for col, name in TARGET_PRODUCTS.items()),
        any_flag(lib == ATTAMINE_PRODUCT).alias("has_attamine"),
        any_flag(lib.contains(INJAD_MARKER)).alias("has_injad"),
        F.countDistinct("CODE_PRODUIT").alias("nb_insurance_products"),
    ]


def _comptes(as_of):
    return [
        F.countDistinct("CCLE").alias("nb_accounts"),
        F.min("DTOUVR").alias("first_account_date"),
        F.datediff(as_of, F.min("DTOUVR")).alias("anciennete_days"),
    ]


def _soldes(_):
    v = "SOLDEVERIF"
    return [
        money_avg(v).alias("avg_balance"),
        F.max(v).alias("max_balance"),
        F.min(v).alias("min_balance"),
        std_samp(v).alias("std_balance"),
        F.count("DATE_CHARG").alias("nb_balance_snapshots"),
        # latest snapshot; equal dates resolved by the larger balance so the survivor is fixed
        F.max_by(v, F.struct("DATE_CHARG", v)).alias("last_balance"),
    ]


def _flux(_):
    v = "FLUX_CRED"
    return [
        money_sum(v).alias("total_flux_cred"),
        money_avg(v).alias("avg_flux_cred"),
        F.max(v).alias("max_flux_cred"),
        std_samp(v).alias("std_flux_cred"),
        F.countDistinct("DATE_CHARG").alias("nb_flux_months"),
    ]


def _spend(prefix: str, amount: str, day: str | None, with_max: bool, nb_name: str):
    def aggs(_):
        out = [
            F.count(F.lit(1)).alias(nb_name),
            money_sum(amount).alias(f"total_{prefix}_amount"),
            money_avg(amount).alias(f"avg_{prefix}_amount"),
        ]
        if with_max:
            out.append(F.max(amount).alias(f"max_{prefix}_amount"))
        if day:
            out.append(F.countDistinct(day).alias(f"nb_{prefix}_active_days"))
        return out

    return aggs


def _digital(_):
    return [
        present().alias("has_digital_product"),
        any_flag(F.col("DATE_RES_ABON").isNull()).alias("has_active_digital"),
        F.countDistinct("CLE").alias("nb_digital_products"),
    ]


def _carte(as_of):
    return [
        present().alias("has_carte"),
        F.countDistinct("NUMERO_CARTE").alias("nb_cartes"),
        any_flag(F.col("DT_FIN_VALID") >= as_of).alias("has_valid_carte"),
    ]


def _opk(_):
    return [
        present().alias("has_pack"),
        F.countDistinct("CODE_PACK").alias("nb_packs_ever"),
        any_flag(F.col("ETATC") == ACTIVE_PACK_STATE).alias("has_active_pack"),
    ]


def _depot(_):
    t = F.col("TYPE_DEPOT")
    return [
        F.count(F.lit(1)).alias("nb_depots"),
        money_sum("MONTANT_DEPOT").alias("total_depot_amount"),
        money_avg("MONTANT_DEPOT").alias("avg_depot_amount"),
        *(any_flag(t == label).alias(col) for col, label in DEPOSIT_TYPES.items()),
    ]


def _mad(_):
    t = F.col("TYPE")
    return [
        F.count(F.lit(1)).alias("nb_mad_operations"),
        money_sum("MONTANT").alias("total_mad_amount"),
        money_avg("MONTANT").alias("avg_mad_amount"),
        *(count_where(t == label).alias(col) for col, label in MAD_TYPES.items()),
    ]


def _vignette(_):
    return [
        present().alias("has_vignette"),
        F.countDistinct("ANNEE_PAIEMENT").alias("nb_vignette_years"),
        money_sum("TOTAL_TTC").alias("total_vignette_amount"),
        F.max("ANNEE_PAIEMENT").alias("last_vignette_year"),
    ]


# Order = column order of the master table.
GROUPS: dict[str, FeatureGroup] = {
    g.name: g
    for g in [
        FeatureGroup("labels", "assurance", _labels, lambda: F.col("ETATC") == ACTIVE_POLICY_STATE),
        FeatureGroup("comptes", "comptes", _comptes),
        FeatureGroup("soldes", "soldes", _soldes),
        FeatureGroup("flux", "flux", _flux),
        FeatureGroup("gab", "gab", _spend("gab", "MONTANT", "DATE_OP", True, "nb_gab_transactions")),
        FeatureGroup("tpe", "tpe", _spend("tpe", "MONTANT_TRANSACTION", "DATE_ACHAT", True, "nb_tpe_transactions")),
        FeatureGroup("retrait", "retrait", _spend("retrait", "MONTANT", None, False, "nb_retraits")),
        FeatureGroup("online", "online_ope", _spend("online", "MONTANT", "DATE_ACHAT", False, "nb_online_transactions")),
        FeatureGroup("digital", "digital", _digital),
        FeatureGroup("payfac", "payfac", _spend("payfac", "MONTANT_TOTAL", None, False, "nb_payfac_transactions")),
        FeatureGroup(
            "virement",
            "virement",
            _spend("virement", "MT_OPE", None, False, "nb_virements"),
            lambda: F.col("ETAT").isin(*TRANSFER_STATES),
        ),
        FeatureGroup("carte", "carte", _carte),
        FeatureGroup("opk", "opk", _opk),
        FeatureGroup("depot", "depot", _depot),
        FeatureGroup("mad", "mad", _mad),
        FeatureGroup("vignette", "vignette", _vignette),
    ]
}

# Base columns kept from the perimeter (DATE_OF_BIRTH is turned into age).
BASE_COLUMNS = [
    "RADICAL", "BANQUE", "AGENCE", "DATE_OF_BIRTH", "CODE_VILLE", "LIBELLE_VILLE", "BPR",
    "GENDER", "MARITAL_STATUS", "NOMBRE_ENFANT", "CUSTOMER_RATING", "TAILLE_ENTREPRI",
]


def base_customers(perimetre: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """Customer base: 11 descriptive columns plus ``age`` in whole years."""
    age = F.floor(F.datediff(_as_of(as_of), F.col("DATE_OF_BIRTH")) / 365)
    return perimetre.select(*BASE_COLUMNS).withColumn("age", age).drop("DATE_OF_BIRTH")


def latest_value(df: DataFrame, key: str, value: str, order: str, out: str) -> DataFrame:
    """Value of the latest row per key (ties on ``order`` resolved by the larger value), in one
    aggregate: ``max_by(value, struct(order, value))``. Partial aggregation keeps a hot key cheap;
    no window over a whole key, no self-join."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(out))


def feature_group(name: str, df: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    return GROUPS[name].build(df, as_of)
