"""The tables the operators work on, as one bundle of lazy frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Domain:
    """Frames with short column names; every id is a string.

    students         std_no, dept, gender
    courses          std_no, dept, course                 (completed; rows may repeat)
    ratings          std_no, item, star, kind             (kind C course, N programme)
    programmes       programme, area
    enrolments       std_no, enrol_id, programme, state
    activities       std_no, act_type, title
    graduates        std_no, dept, gender, company
    company_ratings  company, w_company, w_headcount
    applications     posting_id, reg_date, std_no, applied
    postings         posting_id, company
    searches         search_id, std_no, reg_date, company
    """

    students: DataFrame
    courses: DataFrame
    ratings: DataFrame
    programmes: DataFrame
    enrolments: DataFrame
    activities: DataFrame
    graduates: DataFrame
    company_ratings: DataFrame
    applications: DataFrame
    postings: DataFrame
    searches: DataFrame

    @staticmethod
    def from_collections(tables: dict[str, DataFrame]) -> "Domain":
        """Project the raw collections (see ``sources.schemas``) to short names."""

        def pick(collection: str, **columns: str) -> DataFrame:
            source = tables[collection]
            return source.select(*[F.col(f"`{raw}`").alias(name) for name, raw in columns.items()])

        ids = lambda df: df.select(
            *[F.col(c).cast("string").alias(c) if c == "std_no" else F.col(c) for c in df.columns]
        )
        weights = pick(
            "CPS_RATING", company="기업명", w_company="기업가중치", w_headcount="직원수 가중치"
        ).select(
            "company",
            F.col("w_company").try_cast("int").alias("w_company"),
            F.col("w_headcount").try_cast("int").alias("w_headcount"),
        )
        return Domain(
            students=ids(
                pick("V_STD_CDP_SREG", std_no="STD_NO", dept="SUST_CD_NM", gender="GEN_FG_NM")
            ),
            courses=ids(
                pick("V_STD_CDP_PASSCURI", std_no="STD_NO", dept="SUST_CD_NM", course="SBJT_KEY_CD")
            ),
            ratings=ids(
                pick(
                    "CPS_STAR_POINT",
                    std_no="STD_NO",
                    item="STAR_KEY_ID",
                    star="STAR_POINT",
                    kind="TYPE",
                )
            ),
            programmes=pick("CPS_NCR_PROGRAM_INFO", programme="NPI_KEY_ID", area="NPI_AREA_SUB_CD"),
            enrolments=ids(
                pick(
                    "CPS_NCR_PROGRAM_STD",
                    std_no="NPS_STD_NO",
                    enrol_id="NPS_KEY_ID",
                    programme="NPI_KEY_ID",
                    state="NPS_STATE",
                )
            ),
            activities=ids(
                pick(
                    "CPS_OUT_ACTIVITY_MNG",
                    std_no="OAM_STD_NO",
                    act_type="OAM_TYPE_CD",
                    title="OAM_TITLE",
                )
            ),
            graduates=ids(
                pick(
                    "CPS_GRADUATE_CORP_INFO",
                    std_no="GCI_STD_NO",
                    dept="GCI_SUST_CD_NM",
                    gender="GCI_GEN_FG_NM",
                    company="GCI_CORP_NM",
                )
            ),
            company_ratings=weights,
            applications=ids(
                pick(
                    "CPS_SCHOOL_EMPLOY_STD_INFO",
                    posting_id="SCE_INFO_KEY_ID",
                    reg_date="REG_DATE",
                    std_no="SCE_STD_NO",
                    applied="SCE_STD_APPLY_YN",
                )
            ),
            postings=pick("CPS_SCHOOL_EMPLOY_INFO", posting_id="SCE_KEY_ID", company="SCE_COMP_TITLE"),
            searches=ids(
                pick(
                    "CPS_EMPLOY_SEARCH_HIS",
                    search_id="ESH_KEY_ID",
                    std_no="REG_ID",
                    reg_date="REG_DATE",
                    company="CORP_NM",
                )
            ),
        )
