"""Explicit schemas of the raw tables (source column names)."""

from __future__ import annotations

from pyspark.sql.types import StructType

LINEAGE = "_loaded_at string, _batch_id string, _source_table string"

# Raw tables and their columns.
RAW_COLUMNS = {
    "wtmiss": "PER_ID long, CNT_ID long, TIE_ID long, TIES_SERV long, RGPCNT_ID long, FINMISS_CODE string, "
    "MISS_SAISIE_DTFIN string, MISS_FLAGDPAE string, CMD_ID double, MISS_ANNULE int",
    "wtcnti": "PER_ID long, CNT_ID long, CNTI_ORDRE int, TIE_ID long, MET_ID long, CNTI_DATEFFET string, "
    "CNTI_DATEFINCNTI string, CNTI_THPAYE decimal(18,4), CNTI_THFACT decimal(18,4), CNTI_DURHEBDO decimal(18,2), "
    "CNTI_POSTE string, PCS_CODE_2003 string",
    "wtefac": "EFAC_NUM string, RGPCNT_ID long, TIE_ID long, TIES_SERV long, EFAC_TYPF string, EFAC_DTEEDI string, "
    "EFAC_DTEECH string, EFAC_DTEREGLF string, EFAC_TAUXTVA string",
    "wtlfac": "FAC_NUM string, LFAC_ORD int, LFAC_LIB string, LFAC_BASE decimal(18,2), LFAC_TAUX decimal(18,4), "
    "LFAC_MNT decimal(18,2)",
    "wtprh": "PRH_BTS long, PER_ID long, CNT_ID long, TIE_ID long, PRH_FLAG_RH string, PRH_MODIFDATE string",
    "wtrhdon": "PRH_BTS long, RHD_LIGNE int, RHD_ORIRUB string, RHD_BASEP decimal(18,2), RHD_TAUXP decimal(18,4), "
    "RHD_BASEF decimal(18,2), RHD_TAUXF decimal(18,4), RHD_LIBRUB string, RHD_DATED string",
    "wtcmd": "CMD_ID double, RGPCNT_ID long, CMD_DTE string, CMD_NBSALS int, STAT_CODE string, STAT_TYPE string",
    "wtplac": "PLAC_ID long, RGPCNT_ID long, TIE_ID long, MET_ID long, PLAC_DTEEDI string",
    "wtfacinfo": "CNT_ID long, FAC_NUM string, PER_ID long, TIE_ID long",
    "wtfinmiss": "FINMISS_CODE string, FINMISS_LIBELLE string, MTFCNT_ID string",
    "pymtfcnt": "MTFCNT_ID string, MTFCNT_CODE string, MTFCNT_LIBELLE string, MTFCNT_FINCNT string",
    "pycontrat": "PER_ID long, CNT_ID long, ETA_ID long, RGPCNT_ID long, CNT_DATEDEB string, CNT_DATEFIN string, "
    "CNT_FINPREVU string, LOTPAYE_CODE string, TYPCOT_CODE string, CNT_AVT_ORDRE int, CNT_INI_ORDRE int",
    "wttieserv": "TIE_ID long, TIES_SERV long, TIES_DESIGNATION string, TIES_SIREN string, TIES_NIC string, NAF string, "
    "NAF2008 string, TIES_ADR1 string, TIES_ADR2 string, TIES_CODEP string, TIES_VILLE string, TIES_EMAIL string, "
    "PAYS_CODE string, RGPCNT_ID long, CLOT_DAT string",
    "wtclpt": "TIE_ID long, CLPT_PROS string, CLPT_CAPT decimal(18,2), CLPT_DCREA string, CLPT_EFFT string",
    "wttieint": "TIE_ID long, TIEI_ORDRE int, TIEI_NOM string, TIEI_PRENOM string, TIEI_EMAIL string, TIEI_BUREAU string, "
    "FCTI_CODE string",
    "wtencoursg": "ENCGRP_ID long, ENC_SIREN string, ENCG_DECISIONLIB string",
    # Neutral names: the source that ingestion is given renames the fields of the CRM in use.
    "sf_accounts": "ACCOUNT_CLIENT_ID string, ACCOUNT_NAF_NAME string, ACCOUNT_STATUS string",
    "pypersonne": "PER_ID long, PER_NOM string, PER_PRENOM string, PER_NAISSANCE string, PER_NIR string, NAT_CODE string, "
    "PAYS_CODE string, PER_BISVOIE string, PER_COMPVOIE string, PER_CP string, PER_VILLE string",
    "pysalarie": "PER_ID long, SAL_MATRICULE string, SAL_DATEENTREE string, SAL_ACTIF string",
    "wtpint": "PER_ID long, PINT_CANDIDAT string, PINT_PERMANENT string, PINT_PREVENDTE string, PINT_DERVENDTE string, "
    "PINT_CREATDTE string",
    "wtugpint": "PER_ID long, RGPCNT_ID long",
    "wtpeval": "PER_ID long, PEVAL_DU string, PEVAL_EVALUATION string, PEVAL_UTL string",
    "pycoordonnee": "PER_ID long, TYPTEL_CODE string, PER_TEL_NTEL string, PER_TEL_POSTE string",
    "wtpmet": "PER_ID long, PMET_ORDRE int, MET_ID long",
    "wtmet": "MET_ID long, MET_CODE string, MET_LIBELLE string, TQUA_ID string, SPE_ID string, NIVQ_ID string, "
    "PCS_CODE_2003 string, MET_DELETE string",
    "wtqua": "TQUA_ID string, TQUA_LIBELLE string",
    "wtphab": "PER_ID long, THAB_ID string, PHAB_DELIVR string, PHAB_EXPIR string",
    "wtthab": "THAB_ID string, THAB_LIBELLE string, THAB_NBMOIS string",
    "wtpdip": "PER_ID long, TDIP_ID string, PDIP_DATE string",
    "wttdip": "TDIP_ID string, TDIP_LIB string, TDIP_REF string",
    "wtexp": "PER_ID long, EXP_ORDRE long, EXP_NOM string, EXP_DEBUT string, EXP_FIN string",
    "pyregroupecnt": "RGPCNT_ID long, RGPCNT_CODE string, RGPCNT_LIBELLE string, DATE_CLOTURE string",
    "agence_gestion": "ID_UG long, NOM_UG string, MARQUE string, BRANCHE string, NOM_COMMERCIAL string, CODE_COMM string, "
    "DATE_UG_GEST string",
    "secteurs": "`Agence de gestion` string, Secteur string, `Périmètre` string, `Zone Géographique` string",
}


def raw_schema(table: str) -> StructType:
    """Declared columns of a raw table plus the load lineage."""
    return StructType.fromDDL(f"{RAW_COLUMNS[table]}, {LINEAGE}")


def column_list(table: str) -> list[str]:
    """Whitelist of source columns to extract."""
    return StructType.fromDDL(RAW_COLUMNS[table]).names
