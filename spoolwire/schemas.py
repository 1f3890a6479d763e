"""Declared record schemas."""

from pyspark.sql import types as T

# The regional patent-statistics record as the source
# application's consumer declares it, field names in file order, all strings.
PATENT_FIELDS = [
    "ID",
    "年份",
    "地区",
    "行政区划代码",
    "所属省份",
    "所属地域",
    "长江经济带",
    "专利申请总量",
    "专利申请_发明专利",
    "专利申请_实用新型",
    "专利申请_外观设计",
    "专利授权总量",
    "专利授权_发明专利",
    "专利授权_实用新型",
    "专利授权_外观设计",
    "Unnamed: 15",
]

PATENT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in PATENT_FIELDS])


def string_schema(names: list[str]) -> T.StructType:
    """All-string record schema for the given field names (what a CSV header yields)."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
