"""Record schemas. All delimited inputs are positional and have no header."""

from __future__ import annotations

from pyspark.sql.types import StructType

BEHAVIOR = "user_id int, item_id int, type_id int, behavior string, ts_s long"
ACCESS_LOG = "ip string, ts_ms long, timezone string, way string, url string"
STUDENT = "class_name string, stu_no string, name string, gender string, score int"
SENSOR = "id string, temperature double, ts_s long"
SENSOR_INT = "id string, temperature int, ts_s long"
ORDER = "order_id int, customer_id int, item_id int, price double, ts_s long"
AD_CLICK = "user_id long, ad_id long, province string, city string, ts_s long"


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
