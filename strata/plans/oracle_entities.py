"""DuckDB oracle SQL of the Silver entities: the Bronze defects as a CTE, then each entity's rules."""

from __future__ import annotations

from strata.plans.oracle import AS_OF, with_ctes

# name -> (date column in range, amount, text columns, other columns as they are)
_COLUMNS = {
    "perimetre": ("DATE_OF_BIRTH", None, "BANQUE AGENCE CODE_VILLE LIBELLE_VILLE BPR GENDER MARITAL_STATUS CUSTOMER_RATING "
                  "TAILLE_ENTREPRI", "NOMBRE_ENFANT"),
    "assurance": (None, None, "ETATC LIBELLE_PRODUIT CODE_PRODUIT", ""),
    "comptes": ("DTOUVR", None, "", ""),
    "soldes": ("DATE_CHARG", "SOLDEVERIF", "", ""),
    "flux": ("DATE_CHARG", "FLUX_CRED", "", ""),
    "gab": ("DATE_OP", "MONTANT", "", ""),
    "tpe": ("DATE_ACHAT", "MONTANT_TRANSACTION", "", ""),
    "retrait": ("DATE_OP", "MONTANT", "", "NUM_CARTE"),
    "online_ope": ("DATE_ACHAT", "MONTANT", "", ""),
    "digital": (None, None, "CLE", "DATE_RES_ABON"),
    "payfac": (None, "MONTANT_TOTAL", "", ""),
    "virement": (None, "MT_OPE", "ETAT", ""),
    "carte": (None, None, "", "DT_FIN_VALID"),
    "opk": (None, None, "CODE_PACK ETATC", ""),
    "depot": (None, "MONTANT_DEPOT", "TYPE_DEPOT", ""),
    "mad": (None, "MONTANT", "TYPE", ""),
    "vignette": (None, "TOTAL_TTC", "", "ANNEE_PAIEMENT"),
}
_DRIFT = ("gab", "tpe")  # customers with an odd key come from a second source: no date, a channel
_EXTRA = {"comptes": ("CCLE", "CASE WHEN CCLE % 37 = 0 THEN NULL ELSE CAST(CCLE AS VARCHAR) END",
                      "CAST(trunc(TRY_CAST(trim(CCLE) AS DECIMAL(38,10))) AS BIGINT)"),
          "carte": ("NUMERO_CARTE", "CASE WHEN NUMERO_CARTE % 31 <> 0 THEN NUMERO_CARTE END", "CAST(NUMERO_CARTE AS BIGINT)")}
_KEEP = {"comptes": "CCLE IS NOT NULL", "carte": "NUMERO_CARTE IS NOT NULL",
         "soldes": "(SOLDEVERIF IS NULL OR SOLDEVERIF >= 0)", "depot": "(MONTANT_DEPOT IS NULL OR MONTANT_DEPOT >= 0)"}


def _sql(name: str) -> str:
    day, amount, texts, others = _COLUMNS[name]
    view = "perimetre_raw" if name == "perimetre" else name
    raw = ["""CASE WHEN RADICAL % 53 = 0 THEN NULL WHEN RADICAL % 7 = 0 THEN '  ' || CAST(RADICAL AS VARCHAR) || ' '
              ELSE CAST(RADICAL AS VARCHAR) END AS RADICAL"""]
    typed = ["CAST(trunc(TRY_CAST(trim(RADICAL) AS DECIMAL(38,10))) AS BIGINT) AS RADICAL"]
    keep = ["RADICAL IS NOT NULL"]
    if day:
        text = f"""CASE day({day}) WHEN 13 THEN 'n/a' WHEN 17 THEN '1899-12-31' WHEN 19 THEN '2030-01-01'
                   ELSE strftime({day}, '%Y-%m-%d') END"""
        raw.append(f"CASE WHEN RADICAL % 2 = 0 THEN {text} END AS {day}" if name in _DRIFT else f"{text} AS {day}")
        typed.append(f"TRY_CAST(try_strptime(trim({day}), '%Y-%m-%d') AS DATE) AS {day}")
        floor = "1900-01-01" if name == "perimetre" else "1990-01-01"
        keep.append(f"({day} IS NULL OR {day} BETWEEN DATE '{floor}' AND {AS_OF})")
    if amount:
        raw.append(f"CASE WHEN CAST(floor({amount}) AS BIGINT) % 11 = 0 THEN -{amount} ELSE {amount} END AS {amount}")
        typed.append(amount)
    for c in texts.split():
        raw.append(f"CASE WHEN RADICAL % 7 = 0 THEN ' ' || {c} || '  ' ELSE {c} END AS {c}")
        if c == "GENDER":
            typed.append("""CASE WHEN trim(GENDER) = 'Masculin' THEN 'Masculin'
                            WHEN contains(trim(GENDER), 'minin') THEN 'Feminin' END AS GENDER""")
        else:
            typed.append(f"trim({c}) AS {c}")
    for c in others.split():
        raw.append(c)
        typed.append(c)
    if name in _EXTRA:
        c, landed, read = _EXTRA[name]
        raw.append(f"{landed} AS {c}")
        typed.append(f"{read} AS {c}")
    if name in _DRIFT:
        raw.append("CASE WHEN RADICAL % 2 = 1 THEN 'WEB' END AS CANAL")
        typed.append("CANAL")
    if name in _KEEP:
        keep.append(_KEEP[name])
    rows = view
    if name == "retrait":
        rows = "(SELECT * FROM retrait UNION ALL SELECT * FROM retrait WHERE NUM_CARTE % 5 = 0)"
    distinct = "DISTINCT " if name == "retrait" else ""
    return with_ctes(f""", landed AS (SELECT {", ".join(raw)} FROM {rows}),
        typed AS (SELECT {", ".join(typed)} FROM landed)
        SELECT {distinct}* FROM typed WHERE {" AND ".join(keep)}""", [view])


ORACLE = {f"silver_{name}": _sql(name) for name in _COLUMNS}
