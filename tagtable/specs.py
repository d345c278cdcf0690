"""Tag registry and sink schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

HAS = "has"
IS = "is"
MULTI_CODE = "multi_code"
SINGLE_CODE = "single_code"
FREE = "free"


@dataclass(frozen=True)
class TagSpec:
    column: str
    code: str
    kind: str


# Columns, tag codes and labels that the tag table's readers expect.
TAGS = (
    TagSpec("createDate", "CRE_DATE", FREE),
    TagSpec("custNameCn", "CUST_NAME", FREE),
    TagSpec("t1", "IS_TRADEMARK", HAS),
    TagSpec("t2", "IS_PATENT", HAS),
    TagSpec("t3", "IS_CHANGE_LICENSE", IS),
    TagSpec("t4", "IS_PROMOTION", HAS),
    TagSpec("t5", "IS_OFFICIAL_ACCOUNT", HAS),
    TagSpec("t6", "IS_IO", HAS),
    TagSpec("reg_caps2", "REG_CAPS", FREE),
    TagSpec("estimate_date", "ESTIMATE_DATE", FREE),
    TagSpec("cnei_code", "CNEI_CODE", MULTI_CODE),
    TagSpec("cnei_sec_code", "CNEI_SEC_CODE", MULTI_CODE),
    TagSpec("province_code", "MAILING_ADDR_PROVINCE", SINGLE_CODE),
    TagSpec("city_code", "MAILING_ADDR_CITY", SINGLE_CODE),
    TagSpec("county_code", "MAILING_ADDR_ZONE", SINGLE_CODE),
)
YES_NO = {HAS: ("有", "无"), IS: ("是", "否")}
CODE_SEPARATOR = "\u0002"
IMPORT_EXPORT_TEXT = "进出口"
MANUFACTURING_TEXT = "制造业"


def _schema(names: str, **other: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, other.get(n, T.StringType())) for n in names.split()])


TAG_SCHEMA = _schema("CUST_ID TAG_CODE TAG_VALUE TAG_VALUE_NAME DATA_DATE")
CAMPAIGN_SCHEMA = _schema(
    "CUST_ID POPU_PLAT POPU_TYPE SEM_URL RELEASE_TIME POPU_KEYWORD_LIST DATA_DATE",
    RELEASE_TIME=T.DateType(),
)
PREVIEW_SCHEMA = _schema(
    "ent_id t1 t2 t3 t4 t5 t6 reg_caps2 estimate_date cnei cnei_sec province city county",
    **{f"t{i}": T.IntegerType() for i in range(1, 7)},
)
