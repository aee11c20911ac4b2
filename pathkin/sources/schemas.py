"""Explicit schemas of the stored collections, as DDL; nothing is inferred at read time."""

from __future__ import annotations

# Collection names and the columns used from them.
COLLECTIONS: dict[str, str] = {
    "CPS_BOARD_REPLY": "REPLY_KEY_ID string, REG_ID string, REG_DATE timestamp",
    "CPS_CODE_MNG": "CODE_KEY_ID string, CODE_NM string, REG_DATE timestamp",
    "CPS_EMPLOY_SEARCH_HIS": (
        "ESH_KEY_ID string, SEARCH_PARAM string, REG_ID string, REG_DATE timestamp, "
        "CORP_NM string"
    ),
    "CPS_GRADUATE_CORP_INFO": (
        "GCI_STD_NO string, GCI_SUST_CD_NM string, GCI_GEN_FG_NM string, "
        "GCI_CORP_KEY_ID string, GCI_CORP_NM string"
    ),
    "CPS_NCR_PROGRAM_INFO": "NPI_KEY_ID string, NPI_AREA_SUB_CD string",
    "CPS_NCR_PROGRAM_STD": "NPS_STD_NO string, NPS_KEY_ID string, NPI_KEY_ID string, NPS_STATE string",
    "CPS_OUT_ACTIVITY_MNG": "OAM_STD_NO string, OAM_TYPE_CD string, OAM_TITLE string",
    "CPS_SCHOOL_EMPLOY_INFO": (
        "SCE_KEY_ID string, SCE_COMP_TITLE string, SCE_SECTORS string, "
        "SCE_RELATED_DEPTS string"
    ),
    "CPS_SCHOOL_EMPLOY_STD_INFO": (
        "SCE_INFO_KEY_ID string, REG_DATE timestamp, SCE_STD_NO string, "
        "SCE_STD_APPLY_YN string"
    ),
    "CPS_STAR_POINT": "STD_NO string, STAR_KEY_ID string, STAR_POINT double, TYPE string",
    "V_STD_CDP_DEPT": "COLG_CD int, COLG_CD_NM string, SUST_CD string, SUST_CD_NM string",
    "V_STD_CDP_PASSCURI": (
        "STD_NO string, SUST_CD_NM string, SBJT_KOR_NM string, SBJT_KEY_CD string, "
        "COLG_CD int, COLG_CD_NM string"
    ),
    "V_STD_CDP_SREG": (
        "STD_NO string, KOR_NM string, SUST_CD_NM string, GEN_FG_NM string, "
        "GRADT_YN string, COLG_CD int, COLG_CD_NM string, SUST_CD string"
    ),
    "V_STD_CDP_STAF": "STAF_NO string, KOR_NM string, SUST_CD_NM string",
    "V_STD_CDP_SUBJECT": "COLG_CD int, COLG_CD_NM string, SUST_CD_NM string, SBJT_KOR_NM string",
    "USER_SIMILARITY": (
        "QUERY_STD string, STD_NO string, sbjt_similarity double, ncr_similarity double, "
        "acting_similarity double, similarity double"
    ),
    "Recommend_Result": (
        "QUERY_STD string, Rank int, SBJT_KEY_CD string, NPI_KEY_ID string, OAMTYPCD01 string, "
        "OAMTYPCD02 string, OAMTYPCD03_AVG int, OAMTYPCD04_AVG int, OAMTYPCD05_AVG int"
    ),
    "CPS_RATING": "`기업명` string, `기업가중치` string, `직원수 가중치` string",
    "USER_LIST_FOR_SIMILARITY": (
        "STD_NO string, SUBJECT_STAR array<double>, NCR_STAR array<double>, ACTING_COUNT array<int>"
    ),
}

# Header of the company rating file, in file order; the headcount heading is padded.
RATING_HEADER = ["No", "기업형태", "기업명", "직원수", "업종", "소재지", "기업가중치", "직원수 가중치"]
