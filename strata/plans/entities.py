"""The 17 Silver entities: a clean spec each, and their Bronze sources over the fixture.

``bronze`` gives a source as it lands: keys, dates and codes as text. With ``defects`` it also holds
what the specs are there for, by fixed rules that DuckDB can repeat: null and padded keys, dates that do
not parse or lie outside the range, negative amounts, repeated rows, a renamed key, a second source
with other columns and a source that is absent.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.operators.clean import LOAD_TS, CleanSpec
from strata.plans import fixtures as fx
from strata.session import Scratch, scratch_path

DAY = ("date", "yyyy-MM-dd")
KEY = {"RADICAL": "long"}


def _spec(*sources: str, floor: str = "1990-01-01", casts: dict | None = None, **rules) -> CleanSpec:
    rules.setdefault("not_null", ("RADICAL",))
    return CleanSpec(sources=sources, date_floor=floor, casts={**KEY, **(casts or {})}, **rules)


#: A date that may lie in the future (end of a card, end of a subscription) is not cast, so no range holds it.
SPECS: dict[str, CleanSpec] = {
    "perimetre": _spec("perimetre", floor="1900-01-01", casts={"DATE_OF_BIRTH": DAY, "NOMBRE_ENFANT": "int"},
                       normalize_gender=True),
    "assurance": _spec("assurance"),
    "comptes": _spec("comptes_1", "comptes_2", casts={"CCLE": "long", "DTOUVR": DAY}, not_null=("RADICAL", "CCLE")),
    "soldes": _spec("soldes", casts={"SOLDEVERIF": "double", "DATE_CHARG": DAY}, non_negative=("SOLDEVERIF",)),
    "flux": _spec("flux", casts={"FLUX_CRED": "double", "DATE_CHARG": DAY}),
    "gab": _spec("gab_1", "gab_2", "gab_3", casts={"MONTANT": "double", "DATE_OP": DAY}, allow_missing=True),
    "tpe": _spec("tpe_1", "tpe_2", "tpe_3", casts={"MONTANT_TRANSACTION": "double", "DATE_ACHAT": DAY},
                 allow_missing=True),
    "retrait": _spec("retrait", casts={"NUM_CARTE": "long", "DATE_OP": DAY, "MONTANT": "double"},
                     dedup=("RADICAL", "NUM_CARTE", "DATE_OP", "MONTANT")),
    "online_ope": _spec("online_ope", casts={"MONTANT": "double", "DATE_ACHAT": DAY}),
    "digital": _spec("digital"),
    "payfac": _spec("payfac", casts={"MONTANT_TOTAL": "double"}),
    "virement": _spec("virement", casts={"MT_OPE": "double"}, renames={"CONTRAT": "RADICAL"}),
    "carte": _spec("carte", casts={"NUMERO_CARTE": "long"}, not_null=("RADICAL", "NUMERO_CARTE")),
    "opk": _spec("opk"),
    "depot": _spec("depot", casts={"MONTANT_DEPOT": "double"}, non_negative=("MONTANT_DEPOT",)),
    "mad": _spec("mad", casts={"MONTANT": "double"}),
    "vignette": _spec("vignette", casts={"TOTAL_TTC": "double", "ANNEE_PAIEMENT": "int"},
                      renames={"CONTRAT": "RADICAL"}),
}

#: Sources that are not there (the spec must name them all the same).
ABSENT = ("gab_3", "tpe_3")


def bronze(spark: SparkSession, sf_dir: str, source: str, defects: bool, lines: DataFrame | None = None) -> DataFrame:
    """One Bronze source of the fixture (``lines``: see ``fixtures.entity``). The absent ones raise ``FileNotFoundError``."""
    if source in ABSENT:
        raise FileNotFoundError(f"no source {source}")
    name, _, part = source.partition("_") if source[-1].isdigit() else (source, "", "")
    spec = SPECS[name]
    df = fx.perimetre_raw(spark, sf_dir) if name == "perimetre" else fx.entity(spark, sf_dir, name, lines)
    if part:
        # accounts come from two systems by account, card operations from two by customer
        by = F.col("CCLE") if name == "comptes" else F.col("RADICAL")
        df = df.where(by % 2 == int(part) - 1)
    if defects and name == "retrait":
        df = df.unionByName(df.where(F.col("NUM_CARTE") % 5 == 0))
    key = F.col("RADICAL")
    out = {}
    for f in df.schema.fields:
        c, target = F.col(f.name), spec.casts.get(f.name)
        if isinstance(target, tuple):
            x = F.date_format(c, "yyyy-MM-dd")
            if defects:
                x = (F.when(F.day(c) == 13, "n/a").when(F.day(c) == 17, "1899-12-31")
                     .when(F.day(c) == 19, "2030-01-01").otherwise(x))
        elif target == "double":
            x = F.when(F.floor(c) % 11 == 0, -c).otherwise(c) if defects else c
        elif f.name in ("RADICAL", "CCLE"):
            x = c.cast("string")
            if defects:
                rate = 53 if f.name == "RADICAL" else 37
                x = F.when(c % rate == 0, F.lit(None)).when(key % 7 == 0, F.concat(F.lit("  "), x, F.lit(" "))).otherwise(x)
        elif f.name == "NUMERO_CARTE" and defects:
            x = F.when(c % 31 != 0, c)
        elif isinstance(f.dataType, StringType) and defects:
            x = F.when(key % 7 == 0, F.concat(F.lit(" "), c, F.lit("  "))).otherwise(c)
        else:
            x = c
        out["CONTRAT" if f.name == "RADICAL" and spec.renames else f.name] = x
    if defects and part == "2" and spec.allow_missing:
        out = {n: x for n, x in out.items() if not isinstance(spec.casts.get(n), tuple)}
        out["CANAL"] = F.lit("WEB")
    return df.select(*(x.alias(n) for n, x in out.items()))


def land(spark: SparkSession, sf_dir: str, paths, names: list[str], defects: bool) -> Callable[[str], DataFrame]:
    """Write the Bronze sources of some entities; the reader of one of them by name. Order lines are joined to their
    customers once for all entities made of them, and stored until these are written."""
    from strata.sources import sinks

    with Scratch(spark) as scratch:
        several = len(set(names) & set(fx.OF_LINES)) > 1
        lines = scratch.store(fx.order_lines(spark, sf_dir), "lines") if several else None
        for name in names:
            for source in SPECS[name].sources:
                if source not in ABSENT:
                    sinks.write_overwrite(bronze(spark, sf_dir, source, defects, lines), paths.table("bronze", source))
    return lambda source: spark.read.parquet(paths.table("bronze", source))


def silver_entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One entity through the job runner: Bronze written with its defects, cleaned, written, read back."""
    from strata.plans.lake import LakePaths, run_clean

    paths = LakePaths(scratch_path(spark, "entity"))
    reader = land(spark, sf_dir, paths, [name], defects=True)
    status = run_clean(spark, SPECS, reader, paths, only=[name], as_of=fx.AS_OF).first()
    if status["status"] != "written":
        raise RuntimeError(f"{name}: {status['error']}")
    return spark.read.parquet(paths.table("silver", name)).drop(LOAD_TS)


QUERIES = {f"silver_{name}": partial(silver_entity, name=name) for name in SPECS}
