"""Declared schemas of the tables and topics that are read.

Fixed values: the names of tables, topics and fields are those of the data that the
jobs meet, so they can't be chosen here.
"""

from pyspark.sql import types as T

DOCTOR_INFO = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("level", T.IntegerType()),
])

VIDEO_INFO = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("video_length", T.IntegerType()),
])

CREDIT_RULE_CONFIG = T.StructType([
    T.StructField("rule_code", T.StringType()),
    T.StructField("doctor_level", T.IntegerType()),
])

CREDIT_TASK = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("rule_code", T.StringType()),
    T.StructField("task_detail", T.StringType()),
])

# the enriched video topic between job 1 and job 2
DWD_VIDEO_INFO = T.StructType([
    T.StructField("deviceId", T.StringType()),
    T.StructField("userCode", T.StringType()),
    T.StructField("eventCode", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("resourceId", T.StringType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("video_length", T.IntegerType()),
])
