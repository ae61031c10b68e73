"""Declared schemas of the semi-structured inputs (attributes carry an underscore)."""

from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

_VALUE = lambda t: f"STRUCT<_value:{t}>"

ITEM = f"""
_id BIGINT, _type STRING,
name ARRAY<STRUCT<_type:STRING,_value:STRING>>,
description STRING, image STRING,
yearpublished {_VALUE('INT')}, minplayers {_VALUE('INT')}, maxplayers {_VALUE('INT')},
playingtime {_VALUE('INT')}, minplaytime {_VALUE('INT')}, maxplaytime {_VALUE('INT')}, minage {_VALUE('INT')},
poll ARRAY<STRUCT<_title:STRING,_totalvotes:INT,
     results:ARRAY<STRUCT<_numplayers:STRING,result:ARRAY<STRUCT<_value:STRING,_numvotes:INT>>>>>>,
link ARRAY<STRUCT<_type:STRING,_value:STRING,_inbound:STRING>>,
comments STRUCT<_page:INT,comment:ARRAY<STRUCT<_username:STRING,_rating:STRING,_value:STRING>>>,
statistics STRUCT<ratings:STRUCT<usersrated:{_VALUE('INT')},average:{_VALUE('DOUBLE')},
     bayesaverage:{_VALUE('DOUBLE')},stddev:{_VALUE('DOUBLE')},owned:{_VALUE('INT')},
     wanting:{_VALUE('INT')},wishing:{_VALUE('INT')},numweights:{_VALUE('INT')},
     averageweight:{_VALUE('DOUBLE')},ranks:STRUCT<rank:ARRAY<STRUCT<_name:STRING,_value:STRING>>>>>
"""

COLLECTION_ITEM = """
_objectid BIGINT, rating STRUCT<_value:STRING>, status STRUCT<_lastmodified:STRING>
"""

CORRUPT = "_corrupt_record"


def as_text(kind: DataType) -> DataType:
    """The same shape with every leaf a string."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(as_text(kind.elementType))
    return StringType()
