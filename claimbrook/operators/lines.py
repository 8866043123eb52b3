"""Claim lines held side by side in numbered columns, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CARRIER_LINES = 13

# Numbered carrier blocks and the line column each becomes.
CARRIER_BLOCKS = {
    "PRF_PHYSN_NPI": "prf_physn_npi",
    "TAX_NUM": "tax_num",
    "HCPCS_CD": "hcpcs_cd",
    "LINE_NCH_PMT_AMT": "nch_pmt_amt",
    "LINE_BENE_PTB_DDCTBL_AMT": "bene_ptb_ddctbl_amt",
    "LINE_BENE_PRMRY_PYR_PD_AMT": "bene_prmry_pyr_pd_amt",
    "LINE_COINSRNC_AMT": "coinsrnc_amt",
    "LINE_ALOWD_CHRG_AMT": "alowd_chrg_amt",
    "LINE_PRCSG_IND_CD": "prcsg_ind_cd",
    "LINE_ICD9_DGNS_CD": "icd9_dgns_cd",
}


def unpivot_lines(
    claims: DataFrame,
    keep: Sequence[str],
    blocks: dict[str, str],
    lines: int = CARRIER_LINES,
    line_number: str = "line_num",
) -> DataFrame:
    """One row per filled line; lines with nothing in any of the blocks are left out.

    Name only the blocks needed: the others are then not read. Empty lines are dropped
    inside the row, before it multiplies. There is no shuffle.
    """
    entries = []
    for i in range(1, lines + 1):
        cells = [F.col(f"{column}_{i}") for column in blocks]
        line = F.struct(
            F.lit(i).alias(line_number),
            *[c.alias(name) for c, name in zip(cells, blocks.values(), strict=True)],
        )
        entries.append(F.when(F.coalesce(*[c.isNotNull() | F.lit(None) for c in cells]), line))
    return claims.select(*keep, F.inline(F.array_compact(F.array(*entries))))


def carrier_lines(claims: DataFrame, blocks: Sequence[str] | None = None) -> DataFrame:
    """Carrier claims by line, with their header columns."""
    chosen = {b: CARRIER_BLOCKS[b] for b in blocks} if blocks else CARRIER_BLOCKS
    keep = ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_THRU_DT"]
    extra = ["sample"] if "sample" in claims.columns else []
    return unpivot_lines(claims, keep + extra, chosen)
