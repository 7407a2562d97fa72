"""Raw-shaped views over the star tables: the source system's column names, text dates, load times.

They feed the silver builders the way raw batches do: several versions per key, untrimmed text,
codes of the wrong length, numbers delivered as floating point.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans.catalog import Marts


def _text(c: Column) -> Column:
    return c.cast("string")


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _instant(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


class RawViews(Marts):
    @cached_property
    def _line(self) -> DataFrame:
        return self.table("lineitem").withColumn("_loaded_at", _instant("l_shipdate"))

    @cached_property
    def _order(self) -> DataFrame:
        customer = self.table("customer").withColumnRenamed("c_custkey", "o_custkey")
        return self.table("orders").join(customer, "o_custkey").withColumn("_loaded_at", _instant("o_orderdate"))

    # -- assignments -------------------------------------------------------

    @cached_property
    def wtmiss(self) -> DataFrame:
        declared = F.col("l_shipdate") + F.make_dt_interval(hours=(F.col("l_linenumber") - 4) * 6)
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_orderkey").alias("CNT_ID"),
            F.col("l_partkey").alias("TIE_ID"),
            F.col("l_linenumber").alias("TIES_SERV"),
            F.col("l_linenumber").alias("RGPCNT_ID"),
            F.when(F.col("l_linestatus") == "F", F.concat(F.lit(" "), "l_returnflag")).alias("FINMISS_CODE"),
            _day("l_shipdate").alias("MISS_SAISIE_DTFIN"),
            F.when(F.col("l_returnflag") != "N", _instant(declared)).alias("MISS_FLAGDPAE"),
            F.col("l_orderkey").cast("double").alias("CMD_ID"),
            F.when(F.col("l_discount") == 0, "1").otherwise("0").alias("MISS_ANNULE"),
            "_loaded_at",
        )

    @cached_property
    def wtcnti(self) -> DataFrame:
        begin = F.date_sub("l_shipdate", F.col("l_quantity").cast("int"))
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_orderkey").alias("CNT_ID"),
            F.col("l_linenumber").alias("CNTI_ORDRE"),
            F.col("l_partkey").alias("MET_ID"),
            F.col("l_returnflag").alias("PCS_CODE_2003"),
            _text(begin).alias("CNTI_DATEFFET"),
            _day("l_shipdate").alias("CNTI_DATEFINCNTI"),
            F.col("l_extendedprice").alias("CNTI_THPAYE"),
            F.col("l_quantity").alias("CNTI_THFACT"),
            F.col("l_quantity").alias("CNTI_DURHEBDO"),
            F.concat(F.lit("  "), "l_linestatus", F.lit(" ")).alias("CNTI_POSTE"),
            "_loaded_at",
        )

    @cached_property
    def wtcmd(self) -> DataFrame:
        return self._order.select(
            F.col("o_orderkey").cast("double").alias("CMD_ID"),
            F.col("c_nationkey").alias("RGPCNT_ID"),
            _day("o_orderdate").alias("CMD_DTE"),
            F.left("o_orderpriority", F.lit(1)).alias("CMD_NBSALS"),
            F.concat("o_orderstatus", F.lit(" ")).alias("STAT_CODE"),
            F.lit(None).cast("string").alias("STAT_TYPE"),
            "_loaded_at",
        )

    @cached_property
    def wtplac(self) -> DataFrame:
        return self._order.select(
            F.col("o_orderkey").alias("PLAC_ID"),
            F.col("c_nationkey").alias("RGPCNT_ID"),
            F.col("o_custkey").alias("TIE_ID"),
            F.length("o_orderpriority").alias("MET_ID"),
            _day("o_orderdate").alias("PLAC_DTEEDI"),
            "_loaded_at",
        )

    @cached_property
    def wtfinmiss(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self._line.select(
            F.concat(flag, F.lit(" ")).alias("FINMISS_CODE"),
            F.when(flag == "A", "Fin normale").when(flag == "N", "Terme prévu").otherwise("Autre").alias(
                "FINMISS_LIBELLE"
            ),
            F.when(flag == "N", "1").when(flag == "R", "2").alias("MTFCNT_ID"),
            "_loaded_at",
        )

    @cached_property
    def pymtfcnt(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self._order.select(
            F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("MTFCNT_ID"),
            status.alias("MTFCNT_CODE"),
            F.when(status == "F", "Fin de mission TT").when(status == "O", "Démission").otherwise("Changement").alias(
                "MTFCNT_LIBELLE"
            ),
            F.when(status == "P", 0).otherwise(1).alias("MTFCNT_FINCNT"),
            "_loaded_at",
        )

    @cached_property
    def pycontrat(self) -> DataFrame:
        return self._order.select(
            F.col("o_custkey").alias("PER_ID"),
            F.col("o_orderkey").alias("CNT_ID"),
            F.col("c_nationkey").alias("ETA_ID"),
            F.col("c_nationkey").alias("RGPCNT_ID"),
            _day("o_orderdate").alias("CNT_DATEDEB"),
            _text(F.date_add("o_orderdate", 30)).alias("CNT_DATEFIN"),
            _text(F.add_months("o_orderdate", 2)).alias("CNT_FINPREVU"),
            F.concat("o_orderstatus", F.lit(" ")).alias("LOTPAYE_CODE"),
            F.col("c_mktsegment").alias("TYPCOT_CODE"),
            F.left("o_orderpriority", F.lit(1)).alias("CNT_AVT_ORDRE"),
            F.lit("0").alias("CNT_INI_ORDRE"),
            "_loaded_at",
        )

    @cached_property
    def wtfacinfo(self) -> DataFrame:
        return self._line.select(
            F.col("l_orderkey").alias("CNT_ID"),
            F.concat(F.lit(" F"), _text(F.col("l_partkey"))).alias("FAC_NUM"),
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_linenumber").alias("TIE_ID"),
            "_loaded_at",
        )

    # -- time and billing --------------------------------------------------

    @cached_property
    def wtprh(self) -> DataFrame:
        return self._line.select(
            F.col("l_orderkey").alias("PRH_BTS"),
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_orderkey").alias("CNT_ID"),
            F.col("l_partkey").alias("TIE_ID"),
            _instant("l_shipdate").alias("PRH_MODIFDATE"),
            F.when(F.col("l_returnflag") == "R", "0").otherwise("1").alias("PRH_FLAG_RH"),
            "_loaded_at",
        )

    @cached_property
    def wtrhdon(self) -> DataFrame:
        return self._line.select(
            F.col("l_orderkey").alias("PRH_BTS"),
            F.col("l_linenumber").alias("RHD_LIGNE"),
            F.concat(F.lit(" H"), "l_returnflag").alias("RHD_ORIRUB"),
            F.col("l_quantity").alias("RHD_BASEP"),
            F.col("l_discount").alias("RHD_TAUXP"),
            F.col("l_quantity").alias("RHD_BASEF"),
            F.col("l_tax").alias("RHD_TAUXF"),
            F.col("l_linestatus").alias("RHD_LIBRUB"),
            "_loaded_at",
        )

    @cached_property
    def wtefac(self) -> DataFrame:
        settled = F.date_add("o_orderdate", F.col("c_nationkey") * 4)
        return self._order.select(
            F.concat(F.lit(" "), _text(F.col("o_orderkey"))).alias("EFAC_NUM"),
            F.col("c_nationkey").alias("RGPCNT_ID"),
            F.col("o_custkey").alias("TIE_ID"),
            F.left("o_orderpriority", F.lit(1)).alias("TIES_SERV"),
            F.when(F.col("o_orderstatus") == "P", "A ").otherwise("F").alias("EFAC_TYPF"),
            _day("o_orderdate").alias("EFAC_DTEEDI"),
            _text(F.date_add("o_orderdate", 30)).alias("EFAC_DTEECH"),
            F.when(F.col("o_orderstatus") == "F", _text(settled)).alias("EFAC_DTEREGLF"),
            F.when(F.col("o_orderstatus") == "O", "n/a").otherwise("0.2000").alias("EFAC_TAUXTVA"),
            "_loaded_at",
        )

    @cached_property
    def wtlfac(self) -> DataFrame:
        return self._line.select(
            F.concat(_text(F.col("l_orderkey")), F.lit(" ")).alias("FAC_NUM"),
            F.col("l_linenumber").alias("LFAC_ORD"),
            F.col("l_returnflag").alias("LFAC_LIB"),
            F.col("l_quantity").alias("LFAC_BASE"),
            F.col("l_tax").alias("LFAC_TAUX"),
            F.col("l_extendedprice").alias("LFAC_MNT"),
            "_loaded_at",
        )

    # -- clients -----------------------------------------------------------

    @cached_property
    def wttieserv(self) -> DataFrame:
        return self._order.select(
            F.col("o_custkey").alias("TIE_ID"),
            F.left("o_orderpriority", F.lit(1)).alias("TIES_SERV"),
            F.concat(F.lit(" "), "c_name").alias("TIES_DESIGNATION"),
            F.lpad(_text(F.col("o_custkey")), 9, "0").alias("TIES_SIREN"),
            F.when(F.col("o_orderstatus") == "P", "123").otherwise("00012").alias("TIES_NIC"),
            F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("NAF"),
            F.lit("7820Z").alias("NAF2008"),
            F.col("o_orderpriority").alias("TIES_ADR1"),
            F.lit(None).cast("string").alias("TIES_ADR2"),
            _text(F.col("c_nationkey")).alias("TIES_CODEP"),
            F.concat("c_mktsegment", F.lit(" ")).alias("TIES_VILLE"),
            F.concat(F.lit("Contact@"), "c_mktsegment", F.lit(".FR")).alias("TIES_EMAIL"),
            F.when(F.col("o_orderstatus") == "O", "be").alias("PAYS_CODE"),
            F.col("c_nationkey").alias("RGPCNT_ID"),
            F.when(F.col("o_orderstatus") == "P", _day("o_orderdate")).alias("CLOT_DAT"),
            "_loaded_at",
        )

    @cached_property
    def wtclpt(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("TIE_ID"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", "INCONNU")
            .when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
            .alias("CLPT_PROS"),
            F.col("c_acctbal").alias("CLPT_CAPT"),
            F.lit("1994-02-30").alias("CLPT_DCREA"),
            F.lit(" 10-19 ").alias("CLPT_EFFT"),
            F.lit("2001-01-01 00:00:00").alias("_loaded_at"),
        )

    @cached_property
    def crm_accounts(self) -> DataFrame:
        return self.table("customer").filter(F.col("c_acctbal") > 0).select(
            _text(F.col("c_custkey")).alias("ACCOUNT_CLIENT_ID"),
            F.concat(F.lit("Secteur "), "c_mktsegment").alias("ACCOUNT_NAF_NAME"),
            F.lit("Client actif").alias("ACCOUNT_STATUS"),
            F.lit("2001-01-01 00:00:00").alias("_loaded_at"),
        )

    @cached_property
    def wttieint(self) -> DataFrame:
        return self._order.select(
            F.col("o_custkey").alias("TIE_ID"),
            F.left("o_orderpriority", F.lit(1)).alias("TIEI_ORDRE"),
            F.concat("c_name", F.lit(" ")).alias("TIEI_NOM"),
            F.col("o_orderstatus").alias("TIEI_PRENOM"),
            F.concat(_text(F.col("o_orderkey")), F.lit("@mail.fr")).alias("TIEI_EMAIL"),
            F.concat(F.lit("+33 "), _text(F.col("o_orderkey"))).alias("TIEI_BUREAU"),
            F.lit("DRH").alias("FCTI_CODE"),
            "_loaded_at",
        )

    @cached_property
    def wtencoursg(self) -> DataFrame:
        return self._order.select(
            F.col("o_custkey").alias("ENCGRP_ID"),
            F.lpad(_text(F.col("o_custkey")), 9, "0").alias("ENC_SIREN"),
            F.when(F.col("o_orderstatus") != "O", F.concat(F.lit(" "), "o_orderpriority")).alias("ENCG_DECISIONLIB"),
            "_loaded_at",
        )

    # -- workers -----------------------------------------------------------

    @cached_property
    def pypersonne(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("PER_ID"),
            F.concat("s_name", F.lit(" ")).alias("PER_NOM"),
            F.lit("Alex").alias("PER_PRENOM"),
            F.lit("1980-05-17").alias("PER_NAISSANCE"),
            F.when(F.col("s_acctbal") > 0, F.lpad(_text(F.col("s_suppkey")), 13, "1")).otherwise("").alias("PER_NIR"),
            F.lit("FR").alias("NAT_CODE"),
            F.lit(None).cast("string").alias("PAYS_CODE"),
            F.lit("Rue").alias("PER_BISVOIE"),
            F.lit(None).cast("string").alias("PER_COMPVOIE"),
            _text(F.col("s_nationkey")).alias("PER_CP"),
            F.lit(" Lyon ").alias("PER_VILLE"),
            F.lit("2001-01-01 00:00:00").alias("_loaded_at"),
        )

    @cached_property
    def pysalarie(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.concat(F.lit("M"), _text(F.col("l_suppkey"))).alias("SAL_MATRICULE"),
            _day("l_shipdate").alias("SAL_DATEENTREE"),
            F.when(F.col("l_linestatus") == "F", "1").otherwise("maybe").alias("SAL_ACTIF"),
            "_loaded_at",
        )

    @cached_property
    def wtpint(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.when(F.col("l_returnflag") == "A", "true").otherwise("0").alias("PINT_CANDIDAT"),
            F.when(F.col("l_returnflag") == "R", "1").alias("PINT_PERMANENT"),
            "_loaded_at",
        )

    @cached_property
    def wtugpint(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"), F.col("l_linenumber").alias("RGPCNT_ID"), "_loaded_at"
        )

    @cached_property
    def wtpeval(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            _day("l_shipdate").alias("PEVAL_DU"),
            F.col("l_quantity").alias("PEVAL_EVALUATION"),
            F.col("l_partkey").alias("PEVAL_UTL"),
            "_loaded_at",
        )

    @cached_property
    def pycoordonnee(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_returnflag").alias("TYPTEL_CODE"),
            F.concat(F.lit(" 06"), F.lpad(_text(F.col("l_partkey")), 8, "0")).alias("PER_TEL_NTEL"),
            F.lit(None).cast("string").alias("PER_TEL_POSTE"),
            "_loaded_at",
        )

    # -- skills ------------------------------------------------------------

    @cached_property
    def wtpmet(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_partkey").alias("MET_ID"),
            F.col("l_linenumber").alias("PMET_ORDRE"),
            "_loaded_at",
        )

    @cached_property
    def wtmet(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("MET_ID"),
            F.col("p_brand").alias("MET_CODE"),
            F.concat(F.lit(" "), "p_type").alias("MET_LIBELLE"),
            F.when(F.col("p_size") > 45, "1").alias("MET_DELETE"),
            F.concat(F.lit("Q"), _text(F.col("p_size"))).alias("TQUA_ID"),
            F.col("p_size").alias("SPE_ID"),
            F.lit(None).cast("string").alias("NIVQ_ID"),
            F.when(F.col("p_size") > 10, F.col("p_type")).otherwise(" ").alias("PCS_CODE_2003"),
            F.lit("2001-01-01 00:00:00").alias("_loaded_at"),
        )

    @cached_property
    def wtqua(self) -> DataFrame:
        """Qualification labels by part size; several loads per id."""
        return self.table("part").filter(F.col("p_size") > 5).select(
            F.concat(F.lit("Q"), _text(F.col("p_size"))).alias("TQUA_ID"),
            F.concat(F.lit(" "), "p_brand").alias("TQUA_LIBELLE"),
            F.concat(F.lit("2001-01-01 00:00:0"), _text(F.length("p_type"))).alias("_loaded_at"),
        )

    @cached_property
    def wtphab(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_linenumber").alias("THAB_ID"),
            _day("l_shipdate").alias("PHAB_DELIVR"),
            F.when(F.col("l_returnflag") == "R", _text(F.date_add("l_shipdate", 90))).alias("PHAB_EXPIR"),
            "_loaded_at",
        )

    @cached_property
    def wtthab(self) -> DataFrame:
        return self.table("part").filter(F.col("p_size") > 2).select(
            F.col("p_size").alias("THAB_ID"),
            F.concat(F.lit(" "), "p_brand").alias("THAB_LIBELLE"),
            _text(F.col("p_size") * 3).alias("THAB_NBMOIS"),
            F.lit("2001-01-01 00:00:00").alias("_loaded_at"),
        )

    @cached_property
    def wtpdip(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_returnflag").alias("TDIP_ID"),
            _day("l_shipdate").alias("PDIP_DATE"),
            "_loaded_at",
        )

    @cached_property
    def wttdip(self) -> DataFrame:
        """Degree labels exist for two of the three codes."""
        return self._line.filter(F.col("l_returnflag") != "A").select(
            F.col("l_returnflag").alias("TDIP_ID"),
            F.concat(F.lit("Diplôme "), "l_returnflag").alias("TDIP_LIB"),
            F.when(F.col("l_returnflag") == "R", "III").otherwise("").alias("TDIP_REF"),
            F.lit("2001-01-01 00:00:00").alias("_loaded_at"),
        )

    @cached_property
    def wtexp(self) -> DataFrame:
        return self._line.select(
            F.col("l_suppkey").alias("PER_ID"),
            F.col("l_orderkey").alias("EXP_ORDRE"),
            F.when(F.col("l_linestatus") == "F", F.concat(F.lit(" "), "l_returnflag")).alias("EXP_NOM"),
            _day("l_shipdate").alias("EXP_DEBUT"),
            F.lit("open").alias("EXP_FIN"),
            "_loaded_at",
        )

    # -- branches ----------------------------------------------------------

    @cached_property
    def pyregroupecnt(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("RGPCNT_ID"),
            F.concat(F.lit(" "), "n_name").alias("RGPCNT_LIBELLE"),
            F.concat(F.lit("N"), _text(F.col("n_nationkey"))).alias("RGPCNT_CODE"),
            F.when(F.col("n_regionkey") == 4, "2000-06-30").alias("DATE_CLOTURE"),
            F.lit("2001-01-01 00:00:00").alias("_loaded_at"),
        )

    @cached_property
    def agence_gestion(self) -> DataFrame:
        """Branch management, one row per client served: many versions per branch."""
        nation = self.table("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return self.table("customer").join(nation, "c_nationkey").select(
            F.col("c_nationkey").alias("ID_UG"),
            F.concat(F.lit(" "), F.lower("n_name")).alias("NOM_UG"),
            F.col("c_mktsegment").alias("MARQUE"),
            F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise("BTP").alias("BRANCHE"),
            F.col("n_name").alias("NOM_COMMERCIAL"),
            _text(F.col("n_regionkey")).alias("CODE_COMM"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("DATE_UG_GEST"),
        )

    @cached_property
    def secteurs(self) -> DataFrame:
        """Sales sectors by branch name, loaded once per supplier of the branch."""
        nation = self.table("nation").withColumnRenamed("n_nationkey", "s_nationkey")
        region = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.table("supplier").join(nation, "s_nationkey").join(region, "n_regionkey").select(
            F.concat("n_name", F.lit("  ")).alias("Agence de gestion"),
            F.concat(F.lit(" "), "r_name").alias("Secteur"),
            F.left("r_name", F.lit(2)).alias("Périmètre"),
            F.col("r_name").alias("Zone Géographique"),
        )
