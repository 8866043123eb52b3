"""The seven datasets and the five record families behind them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimbrook.functions.naming import DEFAULT_POLICY, CodePolicy, schema_for, semantic_of

SAMPLES = range(1, 21)


@dataclass(frozen=True)
class Kind:
    name: str
    stem: str
    family: str
    halves: bool = False
    rows_per_file: int = 1_000_000

    @property
    def output_name(self) -> str:
        return f"{self.stem}.parquet"

    def file_name(self, sample: int, half: str = "") -> str:
        return f"{self.stem}_Sample_{sample}{half}.csv"


# Dataset names and file stems, in the order datasets are written.
KINDS = [
    Kind("beneficiary_2008", "DE1_0_2008_Beneficiary_Summary_File", "beneficiary"),
    Kind("beneficiary_2009", "DE1_0_2009_Beneficiary_Summary_File", "beneficiary"),
    Kind("beneficiary_2010", "DE1_0_2010_Beneficiary_Summary_File", "beneficiary"),
    Kind("inpatient_claims", "DE1_0_2008_to_2010_Inpatient_Claims", "inpatient"),
    Kind("outpatient_claims", "DE1_0_2008_to_2010_Outpatient_Claims", "outpatient"),
    Kind("prescription_drug_events", "DE1_0_2008_to_2010_Prescription_Drug_Events", "prescription"),
    Kind("carrier_claims", "DE1_0_2008_to_2010_Carrier_Claims", "carrier", True, 2_000_000),
]

KIND_BY_NAME = {k.name: k for k in KINDS}


def kinds_table(spark: SparkSession) -> DataFrame:
    """One row per dataset: its rank, output name and rows per file. Seven rows."""
    rows = [(i, k.name, k.output_name, k.rows_per_file) for i, k in enumerate(KINDS, 1)]
    return spark.createDataFrame(
        rows, "rank int, kind string, output_name string, max_rows_per_file long"
    )


# Columns per family. "NAME*n" stands for NAME_1 .. NAME_n. Codes get their
# type from their name; the types below are for the other columns.
_FAMILY_COLUMNS = {
    "beneficiary": """
        DESYNPUF_ID BENE_BIRTH_DT BENE_DEATH_DT BENE_SEX_IDENT_CD BENE_RACE_CD BENE_ESRD_IND
        SP_STATE_CODE BENE_COUNTY_CD BENE_HI_CVRAGE_TOT_MONS BENE_SMI_CVRAGE_TOT_MONS
        BENE_HMO_CVRAGE_TOT_MONS PLAN_CVRG_MOS_NUM
        SP_ALZHDMTA SP_CHF SP_CHRNKIDN SP_CNCR SP_COPD SP_DEPRESSN SP_DIABETES SP_ISCHMCHT
        SP_OSTEOPRS SP_RA_OA SP_STRKETIA
        MEDREIMB_IP BENRES_IP PPPYMT_IP MEDREIMB_OP BENRES_OP PPPYMT_OP
        MEDREIMB_CAR BENRES_CAR PPPYMT_CAR
    """,
    "inpatient": """
        DESYNPUF_ID CLM_ID SEGMENT CLM_FROM_DT CLM_THRU_DT PRVDR_NUM CLM_PMT_AMT
        NCH_PRMRY_PYR_CLM_PD_AMT AT_PHYSN_NPI OP_PHYSN_NPI OT_PHYSN_NPI CLM_ADMSN_DT
        ADMTNG_ICD9_DGNS_CD CLM_PASS_THRU_PER_DIEM_AMT NCH_BENE_IP_DDCTBL_AMT
        NCH_BENE_PTA_COINSRNC_LBLTY_AM NCH_BENE_BLOOD_DDCTBL_LBLTY_AM CLM_UTLZTN_DAY_CNT
        NCH_BENE_DSCHRG_DT CLM_DRG_CD ICD9_DGNS_CD*10 ICD9_PRCDR_CD*6 HCPCS_CD*45
    """,
    "outpatient": """
        DESYNPUF_ID CLM_ID SEGMENT CLM_FROM_DT CLM_THRU_DT PRVDR_NUM CLM_PMT_AMT
        NCH_PRMRY_PYR_CLM_PD_AMT AT_PHYSN_NPI OP_PHYSN_NPI OT_PHYSN_NPI
        NCH_BENE_BLOOD_DDCTBL_LBLTY_AM NCH_BENE_PTB_DDCTBL_AMT NCH_BENE_PTB_COINSRNC_AMT
        ADMTNG_ICD9_DGNS_CD ICD9_DGNS_CD*10 ICD9_PRCDR_CD*6 HCPCS_CD*45
    """,
    "carrier": """
        DESYNPUF_ID CLM_ID CLM_FROM_DT CLM_THRU_DT ICD9_DGNS_CD*8
        PRF_PHYSN_NPI*13 TAX_NUM*13 HCPCS_CD*13 LINE_NCH_PMT_AMT*13
        LINE_BENE_PTB_DDCTBL_AMT*13 LINE_BENE_PRMRY_PYR_PD_AMT*13 LINE_COINSRNC_AMT*13
        LINE_ALOWD_CHRG_AMT*13 LINE_PRCSG_IND_CD*13 LINE_ICD9_DGNS_CD*13
    """,
    "prescription": """
        DESYNPUF_ID PDE_ID SRVC_DT PROD_SRVC_ID QTY_DSPNSD_NUM DAYS_SUPLY_NUM
        PTNT_PAY_AMT TOT_RX_CST_AMT
    """,
}

_TEXT_COLUMNS = {"BENE_ESRD_IND", "PRVDR_NUM"}
_DOUBLE_PARTS = ("MEDREIMB_", "BENRES_", "PPPYMT_", "_AMT", "_LBLTY_AM", "QTY_DSPNSD_NUM")


def _type_word(column: str) -> str:
    if column in _TEXT_COLUMNS:
        return "text"
    return "double" if any(part in column for part in _DOUBLE_PARTS) else "bigint"


def family_columns(family: str) -> list[tuple[str, str]]:
    """(column, repeated block or '') of a family, in file order."""
    out: list[tuple[str, str]] = []
    for word in _FAMILY_COLUMNS[family].split():
        name, _, count = word.partition("*")
        if count:
            out += [(f"{name}_{i}", name) for i in range(1, int(count) + 1)]
        else:
            out.append((name, ""))
    return out


def family_schema(family: str, policy: CodePolicy = DEFAULT_POLICY) -> T.StructType:
    """Stored schema of a family, so that a known family needs no inference pass.

    Provider numbers and the ESRD indicator are text here, whatever their first file holds.
    """
    names = [c for c, _ in family_columns(family)]
    return schema_for(names, {c: _type_word(c) for c in names}, policy)


def release_schemas(policy: CodePolicy = DEFAULT_POLICY) -> dict[str, T.StructType]:
    """The documented stored schema of every dataset."""
    return {k.name: family_schema(k.family, policy) for k in KINDS}


def field_catalog(spark: SparkSession, policy: CodePolicy = DEFAULT_POLICY) -> DataFrame:
    """Every documented field: which family has it, where, and how it is stored."""
    rows = []
    for family in _FAMILY_COLUMNS:
        fields = family_schema(family, policy).fields
        for i, (f, (_, block)) in enumerate(zip(fields, family_columns(family), strict=True), 1):
            rows.append((family, f.name, block, i, semantic_of(f), f.dataType.simpleString()))
    return spark.createDataFrame(
        rows,
        "family string, column string, block string, position int, semantic string, type string",
    )


def fields_of(spark: SparkSession, schema: T.StructType, family: str) -> DataFrame:
    """The same catalogue for any stored schema, such as one just inferred."""
    rows = [
        (family, f.name, i, semantic_of(f), f.dataType.simpleString())
        for i, f in enumerate(schema.fields, 1)
    ]
    return spark.createDataFrame(
        rows, "family string, column string, position int, semantic string, type string"
    )
